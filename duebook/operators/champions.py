"""The closed scoring loop: trained versions and their saved pipelines, the champion, its predictions, metrics and alerts.

Every step appends to a ``RunLog`` under the id of its run. A step reads what earlier runs left, so numbering, champion
and alert state follow from the logs alone, and a repeated run gives the same rows again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duebook.operators import monitoring
from duebook.operators.scorecard import variant_model
from duebook.sources.runs import RunLog

AUTHOR = "duebook"
#: Versions that one training run may promote.
MOST_PROMOTED = 1_000


def authored(run_date: dt.date) -> dict[str, Column]:
    """Who wrote a row and when, from the run itself."""
    return {"created_at": F.lit(run_date).cast("timestamp"), "created_by": F.lit(AUTHOR)}


def append_versions(log: RunLog, metrics: DataFrame, run_date: dt.date, models: str) -> None:
    """Numbers the versions of a training run after those of earlier runs, saves the pipelines of the promoted ones below
    ``models``, and appends one row a version. ``metrics`` is the metric log of the run's periods: few rows."""
    run_id = run_date.isoformat()
    taken = F.coalesce(log.read(before=run_id).agg(F.max("version_number")).scalar(), F.lit(0))
    place = F.row_number().over(Window.partitionBy("model").orderBy("period", "version"))
    decided = metrics.join(
        monitoring.promotion_decisions(metrics).select(*monitoring.KEY, "approved", "reason"), monitoring.KEY, "left"
    )
    rows = decided.withColumn("model", F.lit(monitoring.MODEL)).withColumn("version_number", taken + place)
    production = (F.col("version_number") == 1) | (F.coalesce("approved", F.lit(0)) == 1)
    end = F.col("period_end").cast("timestamp")
    version_id = F.concat(F.col("model"), F.lit("_v"), F.col("version_number").cast("string"))
    rows = rows.select(
        version_id.alias("version_id"),
        "version_number",
        "model",
        F.col("version").alias("variant"),
        end.alias("trained_at"),
        F.col("period_start").alias("data_start"),
        F.col("period_end").alias("data_end"),
        F.col("n_predictions").alias("n_training"),
        "auc",
        "f1",
        "precision",
        "recall",
        F.when(production, F.concat(F.lit("models/"), version_id)).alias("model_path"),
        F.when(production, "production").otherwise("staging").alias("status"),
        F.when(production, end).alias("deployed_at"),
        F.coalesce("reason", F.lit("no version to compare with")).alias("notes"),
    ).withColumns(authored(run_date))
    log.write(run_id, rows)
    promoted = log.read(upto=run_id).where((F.col("run_id") == run_id) & F.col("model_path").isNotNull())
    found = promoted.select("variant", "model_path").take(MOST_PROMOTED + 1)
    if len(found) > MOST_PROMOTED:
        raise ValueError(f"more than {MOST_PROMOTED} promoted versions in run {run_id}")
    for row in found:
        variant_model(row["variant"]).write().overwrite().save(f"{models}/{row['model_path']}")


def version_states(rows: DataFrame) -> DataFrame:
    """A version in production retires when the next one is deployed."""
    live = F.col("status") == "production"
    later = F.first(F.when(live, F.col("deployed_at")), ignorenulls=True).over(
        Window.partitionBy("model").orderBy("version_number").rowsBetween(1, Window.unboundedFollowing)
    )
    return rows.withColumn("__later", later).select(
        *[c for c in rows.columns if c not in ("status", "retired_at")],
        F.when(live & F.col("__later").isNotNull(), "retired").otherwise(F.col("status")).alias("status"),
        F.when(live, F.col("__later")).alias("retired_at"),
    )


def champion(rows: DataFrame, model: str = monitoring.MODEL):
    """The row of the version in production, or None."""
    live = version_states(rows).where((F.col("model") == model) & (F.col("status") == "production"))
    found = live.select("version_id", "variant", "model_path").take(1)
    return found[0] if found else None


def load_champion(log: RunLog, models: str, run_id: str) -> tuple[PipelineModel, str]:
    """The saved pipeline of the version that was in production at a run, and its version id."""
    row = champion(log.read(upto=run_id))
    if row is None:
        raise LookupError(f"no version in production at {run_id}")
    return PipelineModel.load(f"{models}/{row['model_path']}"), row["version_id"]


def append_predictions(log: RunLog, versions: RunLog, models: str, facts: DataFrame, run_date: dt.date) -> None:
    """Scores customers with the champion of the day and appends them keyed by customer."""
    model, version_id = load_champion(versions, models, run_date.isoformat())
    scored = model.transform(facts).select(
        "customer_id",
        "category",
        F.col("score").alias("probability"),
        "predicted",
        "label",
        F.lit(version_id).alias("version_id"),
    )
    log.write(run_date.isoformat(), scored.withColumns(authored(run_date)))


def append_metrics(log: RunLog, predictions: RunLog, run_date: dt.date, days: int = 1) -> None:
    """One row per version from the predictions of a run; labels come with them."""
    run_id = run_date.isoformat()
    rows = predictions.read(upto=run_id).where(F.col("run_id") == run_id)
    scored = rows.select(
        F.col("version_id").alias("version"), F.lit(run_date.year).alias("period"), F.col("probability").alias("score"), "label"
    )
    found = monitoring.scored_metrics(scored).drop("period", "f1_weighted", "ks", "average_precision")
    first = run_date - dt.timedelta(days=days - 1)
    row = found.withColumnRenamed("version", "version_id").withColumns(
        {
            "metric_id": F.concat_ws("_", "version_id", F.lit(run_id)),
            "timestamp": F.lit(run_date).cast("timestamp"),
            "period_type": F.lit("daily" if days == 1 else f"{days} days"),
            "period_start": F.lit(first),
            "period_end": F.lit(run_date),
            **authored(run_date),
        }
    )
    log.write(run_id, row)


def append_alerts(log: RunLog, metrics: DataFrame, run_date: dt.date) -> None:
    """The rules that fire on the metric rows of a run, as open alerts."""
    fired = monitoring.alerts(metrics).drop("status")
    end = F.col("period_end").cast("timestamp")
    rows = fired.withColumns(
        {
            "alert_id": F.concat_ws("_", "version", "metric_name", F.col("period_end").cast("string")),
            "timestamp": end,
            "period_start": F.trunc("period_end", "year"),
            "status": F.lit("open"),
            **authored(run_date),
        }
    )
    log.write(run_date.isoformat(), rows)


def alert_states(rows: DataFrame, metrics: DataFrame) -> DataFrame:
    """An alert is resolved by the next period of its version in the metric log, whatever that one fires itself."""
    order = Window.partitionBy("version").orderBy("period_end")
    following = metrics.select("version", "period_end", F.lead("period_end").over(order).alias("next_end"))
    known = rows.drop("status", "resolved_at", "resolved_by").join(following, ["version", "period_end"], "left")
    done = F.col("next_end").isNotNull()
    return known.select(
        *[c for c in rows.columns if c not in ("status", "resolved_at", "resolved_by")],
        F.when(done, "resolved").otherwise("open").alias("status"),
        F.col("next_end").cast("timestamp").alias("resolved_at"),
        F.when(done, AUTHOR).alias("resolved_by"),
    )
