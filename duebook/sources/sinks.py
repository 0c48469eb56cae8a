"""Table writers: full overwrite, append-only log, month partitions, clustered rewrite, removal of retired folders; and
table health."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import conform


def overwrite(df: DataFrame, path: str) -> None:
    """Replaces the table and its schema."""
    df.write.mode("overwrite").parquet(path)


def append_log(df: DataFrame, path: str, target: T.StructType | None = None) -> None:
    """Adds rows to an append-only run log, cast to its schema; the first run creates it."""
    (conform(df, target) if target else df).write.mode("append").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replaces only the partitions that ``df`` has rows for.

    AQE sizes the write tasks: small partitions share one, a large one is split over several.
    """
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def written_schema(df: DataFrame, *partitions: str) -> T.StructType:
    """The schema with partition columns last, to read back without inferring their types."""
    fields = {f.name: f for f in df.schema.fields}
    body = [f for f in df.schema.fields if f.name not in partitions]
    return T.StructType(body + [fields[p] for p in partitions])


def write_clustered(df: DataFrame, path: str, order: Sequence[str], files: int | None = None) -> None:
    """Rewrites a table in ranges of ``order`` so that file statistics prune; give a unique last column, so that one
    key with many rows spans several files. Without a number of ``files``, AQE chooses it by size."""
    ranges = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    ranges.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def remove_folders(spark: SparkSession, parent: str, prefix: str, upto: int) -> None:
    """Deletes the folders ``<prefix><number>`` below ``parent`` whose number is at most ``upto``, on any file system."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parent)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(root):
        return
    for status in system.listStatus(root):
        name = status.getPath().getName()
        number = name.removeprefix(prefix)
        if name.startswith(prefix) and number.isdigit() and int(number) <= upto:
            system.delete(status.getPath(), True)


def health(df: DataFrame, name: str) -> DataFrame:
    status = F.when(F.count(F.lit(1)) > 0, "OK").otherwise("EMPTY")
    return df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), status.alias("status"))


def freshness(df: DataFrame, name: str) -> DataFrame:
    """The newest file time of a file-backed table."""
    return df.agg(F.lit(name).alias("table_name"), F.max("_metadata.file_modification_time").alias("last_update"))
