"""A corpus of text files as documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """One row per file: its path, name without ending, whole text and size."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter=pattern)
    path = F.col("_metadata.file_path")
    return files.select(
        path.alias("path"),
        F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1).alias("name"),
        F.col("value").alias("text"),
        F.round(F.col("_metadata.file_size") / 1024.0, 4).alias("size_kb"),
    )
