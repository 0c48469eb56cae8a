"""Append-only tables written run by run: one folder per run id, so that a repeated run replaces its own rows only."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import conform

RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9_-]*")


@dataclass(frozen=True)
class RunLog:
    """Rows of type ``schema`` below ``root``. Run ids sort in the order of the runs, as ISO dates do.

    A run that fails while it replaces its folder leaves that run missing until it is repeated; other runs are never
    touched. Before the first run the table reads as empty.
    """

    spark: SparkSession
    root: str
    schema: T.StructType

    def write(self, run_id: str, rows: DataFrame) -> None:
        if not RUN_ID.fullmatch(run_id):
            raise ValueError(f"not a run id: {run_id!r}")
        conform(rows, self.schema).write.mode("overwrite").parquet(f"{self.root}/run_id={run_id}")

    def read(self, upto: str | None = None, before: str | None = None) -> DataFrame:
        """All rows with their ``run_id``, or those of the runs up to one or before one; other runs' files are not read."""
        schema = T.StructType([*self.schema.fields, T.StructField("run_id", T.StringType())])
        try:
            rows = self.spark.read.schema(schema).parquet(self.root)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
        if upto is not None:
            rows = rows.where(F.col("run_id") <= upto)
        return rows if before is None else rows.where(F.col("run_id") < before)
