"""Distribution drift: two-sample Kolmogorov-Smirnov per feature and chi-square on classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.functions.probability import chi2_p, kolmogorov_p
from duebook.operators.ordering import running_totals, value_counts

# Significance level and the share of drifted features that makes a data set drift.
SIGNIFICANCE = 0.05
DRIFT_SHARE = 0.30


def feature_drift(df: DataFrame, features: Sequence[str], current: str = "is_current", by: Sequence[str] = ()) -> DataFrame:
    """KS distance, p-value and mean shift of every feature between rows with ``current`` false and true.

    All features go through one job: rows are reduced to counts per distinct value, which are then ordered in slots.
    Groups with only one of the two samples are left out.
    """
    is_current = F.col(current)
    measures = {"ref": F.count(F.when(~is_current, 1)), "cur": F.count(F.when(is_current, 1))}
    counts = value_counts(df.select(*by, current, *features), features, by, measures)
    keys = [*by, "feature"]
    v = F.col("value")
    totals = counts.groupBy(*keys).agg(
        F.sum("ref").alias("n_ref"),
        F.sum("cur").alias("n_cur"),
        F.try_divide(F.sum(v * F.col("ref")), F.sum("ref")).alias("mean_ref"),
        F.try_divide(F.sum(v * F.col("cur")), F.sum("cur")).alias("mean_cur"),
    )
    running = running_totals(
        counts.select(*keys, "slot", "value", F.col("ref").alias("upto_ref"), F.col("cur").alias("upto_cur")),
        keys,
        ["slot"],
        ["value"],
        {"upto_ref": "upto_ref", "upto_cur": "upto_cur"},
    )
    both = totals.filter((F.col("n_ref") > 0) & (F.col("n_cur") > 0))
    gap = F.abs(F.col("upto_cur") / F.col("n_cur") - F.col("upto_ref") / F.col("n_ref"))
    distance = running.join(both, keys).groupBy(*keys).agg(
        F.max(gap).alias("distance"), *[F.first(c).alias(c) for c in ("n_ref", "n_cur", "mean_ref", "mean_cur")]
    )
    p = kolmogorov_p(F.col("distance"), F.col("n_ref"), F.col("n_cur"))
    shift = F.try_divide(F.col("mean_cur") - F.col("mean_ref"), F.col("mean_ref")) * 100
    return distance.select(
        *keys,
        "n_ref",
        "n_cur",
        F.round("distance", 6).alias("ks"),
        F.round(p, 6).alias("p_value"),
        (p < SIGNIFICANCE).cast("int").alias("has_drift"),
        F.round("mean_ref", 6).alias("mean_ref"),
        F.round("mean_cur", 6).alias("mean_cur"),
        F.round(shift, 4).alias("mean_shift_pct"),
    )


def drift_summary(drift: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """How many features drifted, their share, whether the data set drifted, and the worst feature."""
    share = F.sum("has_drift") / F.count(F.lit(1))
    return drift.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_features"),
        F.sum("has_drift").alias("n_drifted"),
        F.round(share, 6).alias("drift_share"),
        (share > DRIFT_SHARE).cast("int").alias("dataset_drift"),
        F.max_by("feature", F.struct("ks", "feature")).alias("worst_feature"),
    )


def class_drift(df: DataFrame, label: str, current: Column, name: str) -> DataFrame:
    """Chi-square of the current class counts against the reference shares; expected counts are not rounded."""
    per_class = df.groupBy(label).agg(
        F.count(F.when(~current, 1)).alias("ref"), F.count(F.when(current, 1)).alias("cur")
    )
    sizes = per_class.agg(F.struct(F.sum("ref").alias("ref"), F.sum("cur").alias("cur"))).scalar()
    expected = F.try_divide(F.col("ref").cast("double"), F.col("size.ref")) * F.col("size.cur")
    off = F.col("cur") - F.col("expected")
    part = F.when(F.col("expected") > 0, F.try_divide(off * off, F.col("expected"))).otherwise(
        F.when(F.col("cur") > 0, F.lit(float("inf"))).otherwise(0.0)
    )
    total = (
        per_class.withColumn("size", sizes)
        .withColumn("expected", expected)
        .agg(F.sum(part).alias("statistic"), (F.count(F.lit(1)) - 1).cast("int").alias("dof"))
    )
    p = F.when(F.col("statistic") == float("inf"), 0.0).otherwise(chi2_p(F.col("statistic"), F.col("dof")))
    return total.select(
        F.lit(name).alias("target"),
        F.round("statistic", 6).alias("statistic"),
        "dof",
        F.round(p, 6).alias("p_value"),
        (p < SIGNIFICANCE).cast("int").alias("has_drift"),
    )
