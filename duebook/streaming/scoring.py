"""Scoring of a stream of requests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .ingest import append_available


def score_requests(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    score: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> None:
    """Reads request files as they arrive, scores each row and appends it.

    ``score`` is any row-wise transformation: the fixed scorecard or ``PipelineModel.transform`` of a saved model.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    append_available(score(reader.parquet(folder)), target, checkpoint)
