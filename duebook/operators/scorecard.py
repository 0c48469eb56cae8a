"""Point-in-time default scorecard: features before a cut-off date, label after it, logistic score.

The formula is fixed, so the evaluation operators can be checked exactly; fitted models live in ``learning``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.sources.ledger import OVERDUE

# Intercept and weights of overdue share, mean amount / 100000, invoice count / 10.
VARIANTS: dict[str, tuple[float, float, float, float]] = {
    "v1": (-1.2, 2.0, 0.1, 0.05),
    "v2": (-0.8, 1.5, 0.05, 0.1),
    "v3": (-1.5, 3.0, 0.2, -0.1),
}
DEFAULT_VARIANT = "v1"
FEATURES = ("overdue_share", "mean_amount", "n_known")
LABEL_PERCENT = 40
LABEL_DAYS = 365

#: Columns that restate the label or are computed from it; no model may train on them.
LEAKAGE = frozenset({"overdue_rate", "n_overdue", "n_later", "n_later_overdue", "label", "recency_score", "category"})


def assert_no_leakage(columns) -> None:
    leaked = sorted(LEAKAGE.intersection(columns))
    if leaked:
        raise ValueError(f"columns leak the label: {leaked}")


def logistic_score(
    weights: tuple[float, float, float, float], share: Column, mean_amount: Column, count: Column
) -> Column:
    a, b_share, b_amount, b_count = (F.lit(w) for w in weights)
    linear = a + b_share * share + b_amount * (mean_amount / F.lit(100000.0)) + b_count * (count / F.lit(10.0))
    return F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-linear)), 6)


def variant_score(variant: str = DEFAULT_VARIANT, share="overdue_share", mean_amount="mean_amount", count="n_known"):
    return logistic_score(VARIANTS[variant], F.col(share), F.col(mean_amount), F.col(count))


def variant_model(variant: str) -> PipelineModel:
    """The formula as a fitted pipeline, which saves, loads and transforms like any trained one."""
    a, b_share, b_amount, b_count = (f"{w!r}D" for w in VARIANTS[variant])
    linear = f"{a} + {b_share} * overdue_share + {b_amount} * (mean_amount / 100000.0D) + {b_count} * (n_known / 10.0D)"
    score = f"round(1.0D / (1.0D + exp(-({linear}))), 6)"
    flag = "CAST(score >= 0.5D AS INT) AS predicted"
    steps = [f"SELECT *, {score} AS score FROM __THIS__", f"SELECT *, {flag} FROM __THIS__"]
    return PipelineModel([SQLTransformer(statement=step) for step in steps])


def scoring_features(invoices: DataFrame, *by: str, when: Column | None = None) -> DataFrame:
    """Overdue share, mean amount and count per customer (and ``by``) over the invoices for which ``when`` holds."""
    when = F.lit(True) if when is None else when
    one = F.when(when, 1)
    late = F.when(when & (F.col("status") == OVERDUE), 1)
    amount = F.sum(F.when(when, F.col("amount"))).cast("double")
    grouped = invoices.groupBy("customer_id", *by).agg(
        F.count(one).alias("n_known"), F.count(late).alias("n_known_overdue"), amount.alias("known_amount")
    )
    return grouped.filter(F.col("n_known") > 0).select(
        "customer_id",
        *by,
        (F.col("n_known_overdue") / F.col("n_known")).alias("overdue_share"),
        (F.col("known_amount") / F.col("n_known")).alias("mean_amount"),
        "n_known",
    )


def overdue_label(n: Column, n_overdue: Column) -> Column:
    return (n_overdue * 100 > n * LABEL_PERCENT).cast("int")


def point_in_time(invoices: DataFrame, as_of: dt.date, days: int = LABEL_DAYS) -> DataFrame:
    """One row per customer with invoices on both sides of ``as_of - days``: earlier features, later label."""
    cutoff = F.lit(as_of - dt.timedelta(days=days))
    early = F.col("issue_date") < cutoff
    late = (F.col("issue_date") >= cutoff) & (F.col("issue_date") <= F.lit(as_of))
    overdue = F.col("status") == OVERDUE
    grouped = invoices.groupBy("customer_id").agg(
        F.count(F.when(early, 1)).alias("n_known"),
        F.count(F.when(early & overdue, 1)).alias("n_known_overdue"),
        F.sum(F.when(early, F.col("amount"))).cast("double").alias("known_amount"),
        F.count(F.when(late, 1)).alias("n_later"),
        F.count(F.when(late & overdue, 1)).alias("n_later_overdue"),
    )
    return grouped.filter((F.col("n_known") > 0) & (F.col("n_later") > 0)).select(
        "customer_id",
        (F.col("n_known_overdue") / F.col("n_known")).alias("overdue_share"),
        (F.col("known_amount") / F.col("n_known")).alias("mean_amount"),
        "n_known",
        overdue_label(F.col("n_later"), F.col("n_later_overdue")).alias("label"),
    )


def add_score(df: DataFrame, variant: str = DEFAULT_VARIANT) -> DataFrame:
    scored = df.withColumn("score", variant_score(variant))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def score_variants(df: DataFrame, variants: Mapping[str, tuple] = VARIANTS) -> DataFrame:
    """One row per input row and variant, with the columns ``version``, ``score`` and ``predicted``."""
    options = F.array(
        *[F.struct(F.lit(name).alias("version"), variant_score(name).alias("score")) for name in variants]
    )
    long = df.select(*df.columns, F.inline(options))
    return long.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
