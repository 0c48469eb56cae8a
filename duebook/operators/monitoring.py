"""Metric log per model version and period, alerts, rollback signals, promotion and the version log.

The log has one row per version and period, so windows over it are small by construction.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duebook.operators import evaluate
from duebook.operators.drift import drift_summary, feature_drift
from duebook.operators.scorecard import FEATURES, overdue_label, score_variants
from duebook.sources.ledger import OVERDUE

KEY = ["version", "period"]
MODEL = "default_scorecard"
# Alert thresholds, rollback triggers, promotion gain, score bands, critical share.
AUC_MIN, F1_MIN, DRIFT_MAX, DRIFT_CRITICAL, VOLUME_MIN, VOLUME_MAX = 0.75, 0.65, 0.30, 0.5, 50, 2000
ROLLBACK_AUC, ROLLBACK_VOLUME, ROLLBACK_DRIFT = 0.70, 0.5, 0.5
PROMOTION_GAIN = 0.02
HIGH_SCORE, MEDIUM_SCORE = 0.6, 0.4
SEVERITIES = ("critical", "high", "medium")
CRITICAL_SHARE_PCT = 30
MAX_DRIFTED = 3


def yearly_cases(invoices: DataFrame) -> DataFrame:
    """Per customer and year: features from that year's invoices, label from the next year's.

    Each invoice is a feature row of its own year and a label row of the year before, so one aggregate does both.
    """
    year = F.year("issue_date")
    roles = F.array(
        F.struct(year.alias("period"), F.lit(True).alias("known")),
        F.struct((year - 1).alias("period"), F.lit(False).alias("known")),
    )
    overdue = F.col("status") == OVERDUE
    rows = invoices.select("customer_id", "amount", overdue.alias("overdue"), F.inline(roles))
    known, overdue = F.col("known"), F.col("overdue")
    grouped = rows.groupBy("customer_id", "period").agg(
        F.count(F.when(known, 1)).alias("n_known"),
        F.count(F.when(known & overdue, 1)).alias("late"),
        F.sum(F.when(known, F.col("amount"))).cast("double").alias("amount"),
        F.count(F.when(~known, 1)).alias("n_later"),
        F.count(F.when(~known & overdue, 1)).alias("n_later_overdue"),
    )
    return grouped.filter((F.col("n_known") > 0) & (F.col("n_later") > 0)).select(
        "customer_id",
        "period",
        (F.col("late") / F.col("n_known")).alias("overdue_share"),
        (F.col("amount") / F.col("n_known")).alias("mean_amount"),
        "n_known",
        overdue_label(F.col("n_later"), F.col("n_later_overdue")).alias("label"),
    )


def metric_log(cases: DataFrame) -> DataFrame:
    """Production metrics per version and period from true labels, with three score bands."""
    return scored_metrics(score_variants(cases))


def scored_metrics(scored: DataFrame) -> DataFrame:
    """The metric log of scored and labelled rows: one table of counts per version, period and score gives every figure."""
    report = evaluate.score_report(scored, KEY, (MEDIUM_SCORE, HIGH_SCORE))
    bands = {"n_low_risk": "band_0", "n_medium_risk": "band_1", "n_high_risk": "band_2"}
    names = {"n_predictions": "n", "avg_score": "mean_score", "actual_default_rate": "positive_rate"}
    names |= {"predicted_default_rate": "predicted_rate", **bands}
    return report.withColumnsRenamed({old: new for new, old in names.items()}).withColumns(
        {
            "metric_id": F.concat_ws("_", "version", F.col("period").cast("string")),
            "period_start": F.make_date(F.col("period"), F.lit(1), F.lit(1)),
            "period_end": F.make_date(F.col("period"), F.lit(12), F.lit(31)),
        }
    )


def period_drift(cases: DataFrame) -> DataFrame:
    """Feature drift of each period against the one before."""
    roles = F.array(
        F.struct(F.col("period"), F.lit(True).alias("is_current")),
        F.struct((F.col("period") + 1).alias("period"), F.lit(False).alias("is_current")),
    )
    rows = cases.select(*FEATURES, F.inline(roles))
    return feature_drift(rows, FEATURES, by=["period"])


def trailing(df: DataFrame, day: str, as_of: dt.date, days: int) -> DataFrame:
    return df.filter(F.col(day) >= F.lit(as_of - dt.timedelta(days=days)))


def metric_trends(log: DataFrame) -> DataFrame:
    return log.groupBy("period_end", "version").agg(
        *[F.round(F.avg(c), 6).alias(f"avg_{c}") for c in ("auc", "f1", "precision", "recall")],
        F.sum("n_predictions").alias("total_predictions"),
    )


def score_distribution(log: DataFrame) -> DataFrame:
    n = F.col("n_predictions")

    def share(band: str) -> Column:
        return F.round(F.col(f"n_{band}_risk") * 100.0 / n, 4).alias(f"pct_{band}_risk")

    return log.select(
        "version",
        "period_start",
        share("low"),
        share("medium"),
        share("high"),
        "avg_score",
        F.round(F.col("predicted_default_rate") * 100, 4).alias("predicted_default_pct"),
        "n_predictions",
    )


def with_drift_share(log: DataFrame, drift: DataFrame) -> DataFrame:
    shares = drift_summary(drift, ["period"]).select("period", "drift_share")
    return log.join(shares, "period", "left")


def alerts(log: DataFrame) -> DataFrame:
    """One row per rule that fires on a log row; alerts of a version's latest period are open."""

    def rule(kind: str, metric: str, fires: Column, limit: float, severity, word: str) -> Column:
        value = F.col(metric).cast("double")
        severity = severity if isinstance(severity, Column) else F.lit(severity)
        return F.struct(
            F.coalesce(fires, F.lit(False)).alias("fires"),
            F.lit(kind).alias("alert_type"),
            severity.alias("severity"),
            F.lit(metric).alias("metric_name"),
            value.alias("current_value"),
            F.lit(float(limit)).alias("threshold_value"),
            F.round(value - float(limit), 6).alias("deviation"),
            F.concat(F.lit(f"{metric} "), F.col(metric).cast("string"), F.lit(f" {word} {limit}")).alias("message"),
        )

    drift_severity = F.when(F.col("drift_share") > DRIFT_CRITICAL, "critical").otherwise("high")
    n = F.col("n_predictions")
    rules = F.array(
        rule("performance", "auc", F.col("auc") < AUC_MIN, AUC_MIN, "high", "below"),
        rule("performance", "f1", F.col("f1") < F1_MIN, F1_MIN, "high", "below"),
        rule("drift", "drift_share", F.col("drift_share") > DRIFT_MAX, DRIFT_MAX, drift_severity, "above"),
        rule("volume", "n_predictions", n < VOLUME_MIN, VOLUME_MIN, "medium", "below"),
        rule("volume", "n_predictions", n > VOLUME_MAX, VOLUME_MAX, "medium", "above"),
    )
    latest = F.max("period").over(Window.partitionBy("version"))
    fired = log.withColumn("latest", latest).select(
        "version",
        "period_end",
        F.when(F.col("period") == F.col("latest"), "open").otherwise("resolved").alias("status"),
        F.inline(F.filter(rules, lambda r: r["fires"])),
    )
    return fired.drop("fires")


def severity_order() -> Column:
    order = F.lit(len(SEVERITIES) + 1)
    for place, name in enumerate(SEVERITIES, 1):
        order = F.when(F.col("severity") == name, place).otherwise(order)
    return order


def open_alerts(fired: DataFrame) -> DataFrame:
    return fired.filter(F.col("status") == "open").orderBy(severity_order(), F.desc("period_end"), "version")


def alert_summary(fired: DataFrame) -> DataFrame:
    return (
        fired.groupBy("alert_type", "severity")
        .agg(
            F.count(F.lit(1)).alias("n_alerts"),
            F.count(F.when(F.col("status") == "open", 1)).alias("n_open"),
            F.count(F.when(F.col("status") == "resolved", 1)).alias("n_resolved"),
            F.max("period_end").alias("last_alert"),
        )
        .orderBy(severity_order(), F.desc("n_alerts"))
    )


def rollback_signals(log: DataFrame) -> DataFrame:
    before = F.lag("n_predictions").over(Window.partitionBy("version").orderBy("period"))
    low = F.col("auc") < ROLLBACK_AUC
    drop = F.coalesce(F.col("n_predictions") < before * ROLLBACK_VOLUME, F.lit(False))
    drift = F.coalesce(F.col("drift_share") > ROLLBACK_DRIFT, F.lit(False))
    flagged = log.select(
        *KEY,
        low.cast("int").alias("auc_low"),
        drop.cast("int").alias("volume_drop"),
        drift.cast("int").alias("drift_critical"),
    )
    any_signal = F.greatest("auc_low", "volume_drop", "drift_critical")
    return flagged.withColumn("roll_back", any_signal)


def promotion_decisions(log: DataFrame) -> DataFrame:
    """Each version against the one before it in the same period: any of AUC and F1 must gain more than the threshold.

    ``no_metric_worse`` guards the rule: it is 0 when the other metric falls by more than the threshold.
    """
    order = Window.partitionBy("period").orderBy("version")
    paired = log.select(
        "period",
        "version",
        F.lag("version").over(order).alias("baseline"),
        F.round(F.col("auc") - F.lag("auc").over(order), 6).alias("auc_gain"),
        F.round(F.col("f1") - F.lag("f1").over(order), 6).alias("f1_gain"),
    ).filter(F.col("baseline").isNotNull())
    auc_gain, f1_gain = F.col("auc_gain"), F.col("f1_gain")
    best = F.greatest(auc_gain, f1_gain)
    approved = best > PROMOTION_GAIN
    metric = F.when(auc_gain >= f1_gain, "auc").otherwise("f1")
    reason = F.when(
        approved, F.concat(F.lit("approved: "), metric, F.lit(" gains "), best.cast("string"))
    ).otherwise(F.lit(f"denied: no gain above {PROMOTION_GAIN}"))
    return paired.select(
        "*",
        approved.cast("int").alias("approved"),
        (F.least(auc_gain, f1_gain) >= -PROMOTION_GAIN).cast("int").alias("no_metric_worse"),
        reason.alias("reason"),
    )


def version_log(log: DataFrame) -> DataFrame:
    """Versions in the order they were trained; approved ones (and the first) go to production, others to staging."""
    order = Window.partitionBy("model").orderBy("period", "version")
    decided = log.join(promotion_decisions(log).select(*KEY, "approved"), KEY, "left").withColumn("model", F.lit(MODEL))
    numbered = decided.withColumn("version_number", F.row_number().over(order))
    production = (F.col("version_number") == 1) | (F.coalesce("approved", F.lit(0)) == 1)
    return numbered.select(
        F.concat(F.col("model"), F.lit("_v"), F.col("version_number").cast("string")).alias("version_id"),
        "version_number",
        "model",
        F.col("period_end").alias("trained_on"),
        F.col("version").alias("variant"),
        "auc",
        "f1",
        "precision",
        "recall",
        F.when(production, "production").otherwise("staging").alias("status"),
    )


def next_version_number(versions: DataFrame, model: str) -> DataFrame:
    known = versions.filter(F.col("model") == model)
    return known.agg((F.coalesce(F.max("version_number"), F.lit(0)) + 1).alias("next_version"))


def current_champion(versions: DataFrame) -> DataFrame:
    """Per model the newest production version and, one step back, the challenger to roll back to."""
    live = versions.filter(F.col("status") == "production")
    place = F.row_number().over(Window.partitionBy("model").orderBy(F.desc("version_number")))
    alias = F.when(F.col("place") == 1, "champion").otherwise("challenger")
    return live.withColumn("place", place).filter(F.col("place") <= 2).select(
        "model", alias.alias("alias"), "version_id", "version_number", "variant", "auc", "f1"
    )


def monitoring_record(summary: DataFrame, scores: DataFrame, critical: Column) -> DataFrame:
    """The monitoring log row of one run: drift counts, share of critical customers, mean probability, status."""
    population = scores.agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.round(F.avg("probability"), 6).alias("mean_probability"),
        F.round(F.count(F.when(critical, 1)) * 100.0 / F.count(F.lit(1)), 4).alias("critical_pct"),
    )
    facts = summary.agg(
        F.struct(F.max("n_drifted").alias("n_drifted"), F.max("n_features").alias("n_features"))
    ).scalar()
    row = population.withColumn("facts", facts).select(
        F.col("facts.n_drifted").alias("n_drifted"),
        F.col("facts.n_features").alias("n_features"),
        "n_predictions",
        "mean_probability",
        "critical_pct",
    )
    drifted, critical_pct = F.col("n_drifted"), F.col("critical_pct")
    bad = (drifted > MAX_DRIFTED) | (critical_pct > CRITICAL_SHARE_PCT)
    return row.select(
        "*",
        F.round(drifted * 100.0 / F.col("n_features"), 4).alias("drift_pct"),
        (drifted > 0).cast("int").alias("drift_alert"),
        (critical_pct > CRITICAL_SHARE_PCT).cast("int").alias("critical_alert"),
        F.when(bad, "CRITICAL").otherwise("OK").alias("status"),
    )


def log_columns() -> Sequence[str]:
    return (
        "metric_id", *KEY, "period_start", "period_end", "n_predictions", "n_high_risk", "n_medium_risk", "n_low_risk",
        "avg_score", "median_score", "accuracy", "precision", "recall", "f1", "f1_weighted", "auc",
        "actual_default_rate", "predicted_default_rate",
    )
