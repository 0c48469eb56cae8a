"""Catalog table scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def money(column: str | Column, scale: int = 2) -> Column:
    """Money as DECIMAL(18, scale): sums are exact, so a task that is run again gives the same total."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast(f"decimal(18,{scale})")
