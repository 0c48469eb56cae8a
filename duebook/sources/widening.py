"""Tables whose later loads bring further columns or wider types: one folder per load, typed by a stored schema."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runs import RUN_ID

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
LOAD = "load_id"


def wider(name: str, stored: T.DataType, new: T.DataType) -> T.DataType:
    """The type that holds both; values of the narrower one are read as they are."""
    if stored == new:
        return stored
    if type(stored) in WHOLE and type(new) in WHOLE:
        return max(stored, new, key=lambda t: WHOLE.index(type(t)))
    if {type(stored), type(new)} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if isinstance(stored, T.DecimalType) and isinstance(new, T.DecimalType):
        scale = max(stored.scale, new.scale)
        precision = max(stored.precision - stored.scale, new.precision - new.scale) + scale
        if precision <= 38:
            return T.DecimalType(precision, scale)
    raise ValueError(f"column {name}: {new.simpleString()} does not fit {stored.simpleString()}")


def widened(stored: T.StructType, new: T.StructType) -> T.StructType:
    """The stored columns in their order, made wide enough for ``new``, then the columns that only ``new`` has.

    Names are compared as Spark does by default, without case; all columns can be null, as older rows lack the new ones.
    """
    arriving = {f.name.lower(): f for f in new.fields}
    if len(arriving) < len(new.fields):
        raise ValueError("two columns differ by case only")
    fields = []
    for f in stored.fields:
        match = arriving.pop(f.name.lower(), None)
        fields.append(T.StructField(f.name, wider(f.name, f.dataType, match.dataType) if match else f.dataType))
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in arriving.values()])


@dataclass(frozen=True)
class WideningTable:
    """Rows below ``root/loads``, schemas below ``root/schemas``.

    The schema is stored before the rows: a load that fails between the two leaves columns that are null everywhere. A
    load that is repeated replaces its own rows. One writer at a time. Readers take the newest stored schema, so no file
    footer is read to find the columns; a column that a file lacks is null.
    """

    spark: SparkSession
    root: str

    def schema(self) -> T.StructType | None:
        """None before the first load."""
        try:
            stored = self.spark.read.schema("fields string, version int").parquet(f"{self.root}/schemas")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        newest = stored.orderBy(F.desc("version")).first()
        return T.StructType.fromJson(json.loads(newest.fields)) if newest else None

    def append(self, load_id: str, rows: DataFrame) -> None:
        if not RUN_ID.fullmatch(load_id):
            raise ValueError(f"not a load id: {load_id!r}")
        if LOAD in (c.lower() for c in rows.columns):
            raise ValueError(f"{LOAD} is the table's own column")
        stored = self.schema()
        target = widened(stored or T.StructType([]), rows.schema)
        if target != stored:
            version = 1 if stored is None else self.spark.read.parquet(f"{self.root}/schemas").count() + 1
            row = self.spark.createDataFrame([(target.json(),)], "fields string")
            row.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/schemas/version={version}")
        given = {c.lower() for c in rows.columns}
        cast = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.fields if f.name.lower() in given]
        rows.select(*cast).write.mode("overwrite").parquet(f"{self.root}/loads/{LOAD}={load_id}")

    def read(self) -> DataFrame:
        """All loads with their ``load_id``."""
        schema = self.schema()
        if schema is None:
            return self.spark.createDataFrame([], T.StructType([T.StructField(LOAD, T.StringType())]))
        return self.spark.read.schema(T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])).parquet(f"{self.root}/loads")


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """The same from the files alone, for a table without a stored schema: every footer is read, types must agree."""
    return spark.read.option("mergeSchema", True).parquet(path)
