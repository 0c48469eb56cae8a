"""Stable assignment of customers to arms and the test of two proportions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.functions.keys import hash_bucket
from duebook.functions.probability import normal_cdf

# 95 % interval, significance, share of traffic routed to a challenger.
Z_95 = 1.96
SIGNIFICANCE = 0.05
CHALLENGER_PERCENT = 10


def assign_arms(df: DataFrame, key: str) -> DataFrame:
    """Adds a half-and-half ``arm`` and a 90/10 ``route``; both depend on the key alone."""
    arm = F.when(hash_bucket(F.col(key), 2) == 1, "treatment").otherwise("control")
    route = F.when(hash_bucket(F.col(key), 100, "route") < CHALLENGER_PERCENT, "challenger").otherwise("champion")
    return df.withColumns({"arm": arm, "route": route})


def two_proportion_test(df: DataFrame, treated: Column, outcome: Column) -> DataFrame:
    """One row: does treatment lower the outcome rate? Pooled z, one-sided p, unpooled 95 % interval, lift.

    Empty arms or equal certain outcomes give z = 0; a control rate of 0 gives lift 0.
    """
    hit = outcome.cast("int")
    sums = df.agg(
        F.count(F.when(~treated, 1)).alias("n_control"),
        F.coalesce(F.sum(F.when(~treated, hit)), F.lit(0)).alias("x_control"),
        F.count(F.when(treated, 1)).alias("n_treatment"),
        F.coalesce(F.sum(F.when(treated, hit)), F.lit(0)).alias("x_treatment"),
    )
    n0, n1 = F.col("n_control").cast("double"), F.col("n_treatment").cast("double")
    rates = sums.select(
        "*",
        F.coalesce(F.try_divide(F.col("x_control"), n0), F.lit(0.0)).alias("p0"),
        F.coalesce(F.try_divide(F.col("x_treatment"), n1), F.lit(0.0)).alias("p1"),
        F.coalesce(F.try_divide(F.col("x_control") + F.col("x_treatment"), n0 + n1), F.lit(0.0)).alias("pooled"),
    )
    p0, p1, pooled = F.col("p0"), F.col("p1"), F.col("pooled")
    one = F.lit(1.0)
    se = F.sqrt(pooled * (one - pooled) * (F.try_divide(one, n0) + F.try_divide(one, n1)))
    se_diff = F.sqrt(F.try_divide(p0 * (one - p0), n0) + F.try_divide(p1 * (one - p1), n1))
    z = F.when(se > 0, (p0 - p1) / se).otherwise(0.0)
    p = one - normal_cdf(F.col("z"))
    return rates.select("*", z.alias("z"), se_diff.alias("se_diff")).select(
        "n_control",
        "n_treatment",
        F.round(p0, 6).alias("rate_control"),
        F.round(p1, 6).alias("rate_treatment"),
        F.round(F.when(p0 > 0, (p0 - p1) / p0).otherwise(0.0), 6).alias("relative_lift"),
        F.round(p0 - p1 - Z_95 * F.col("se_diff"), 6).alias("ci_low"),
        F.round(p0 - p1 + Z_95 * F.col("se_diff"), 6).alias("ci_high"),
        F.round("z", 6).alias("z_stat"),
        F.round(p, 6).alias("p_value"),
        (p < SIGNIFICANCE).cast("int").alias("significant"),
    )
