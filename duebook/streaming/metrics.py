"""Daily volume and value per event type from the event stream.

``daily_metrics`` emits a day once, when it is closed. ``upsert_daily_metrics`` also shows the open days: every batch
writes the new totals of the days it touched, and ``current_daily_metrics`` reads the last total of each day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LATENESS = "10 minutes"


def event_stream(spark: SparkSession, folder: str, name: str = "events") -> DataFrame:
    """The events table as a file stream; its time becomes a zoned timestamp, which watermarks need."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def daily_metrics(events: DataFrame) -> DataFrame:
    """Closed days only: a day is emitted once, when the watermark has passed its end."""
    windows = events.withWatermark("ts", LATENESS).groupBy(F.window("ts", "1 day").alias("day"), "event_type")
    sums = windows.agg(
        F.count(F.lit(1)).alias("n_events"),
        F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total_value"),
        F.count(F.when(F.col("event_type") == "error", 1)).alias("n_errors"),
    )
    day = F.col("day.start").cast("date").alias("day")
    return sums.select(day, "event_type", "n_events", "total_value", "n_errors")


def upsert_daily_metrics(events: DataFrame, target: str, checkpoint: str) -> None:
    """Takes in what has arrived. A batch owns its folder, so a batch that is retried replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")

    writer = daily_metrics(events).writeStream.foreachBatch(write).outputMode("update")
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def current_daily_metrics(spark: SparkSession, target: str) -> DataFrame:
    """The last total of each day and event type, open days included."""
    measures = F.struct("n_events", "total_value", "n_errors")
    seen = spark.read.parquet(target).groupBy("day", "event_type")
    return seen.agg(F.max_by(measures, "batch_id").alias("last")).select("day", "event_type", "last.*")
