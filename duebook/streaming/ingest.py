"""Incremental CSV ingestion: new files only, append, drain and stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

CORRUPT = "_corrupt"


def with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def csv_options() -> dict[str, str]:
    return {"header": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def read_csv_drops(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All files in a folder with an explicit schema; a malformed line is kept whole in ``_corrupt``."""
    return spark.read.schema(with_corrupt(schema)).options(**csv_options()).csv(folder)


def csv_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    reader = spark.readStream.schema(with_corrupt(schema)).options(**csv_options())
    return reader.option("maxFilesPerTrigger", files_per_batch).csv(folder)


def append_available(stream: DataFrame, target: str, checkpoint: str, partition: str | None = None) -> StreamingQuery:
    """Appends what has arrived since the checkpoint and stops. Running it again adds nothing new.

    The file sink's own log makes a batch that is retried after a failure appear once.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition:
        writer = writer.partitionBy(partition)
    job = writer.trigger(availableNow=True).start(target)
    job.awaitTermination()
    return job
