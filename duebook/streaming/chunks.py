"""Keeps the chunk table in step with a feed of document versions.

The table is a base that a compaction wrote, named by the newest manifest, and one folder per later batch.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.operators.documents import chunks
from duebook.session import stage
from duebook.sources import sinks

MANIFEST = "base string, upto bigint"


def sync_chunks(spark: SparkSession, feed: str, schema: T.StructType, target: str, checkpoint: str) -> None:
    """Chunks every new document version; a batch owns its folders, so a batch that is retried replaces itself.

    Beside the chunks a batch writes a log of the versions it saw, so that a version without text is known too.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = stage(batch.groupBy("doc_id").agg(F.max_by(F.struct(*batch.columns), "version").alias("d")).select("d.*"))
        sinks.overwrite(chunks(newest, carry=("version",)), f"{target}/chunks/batch_id={batch_id}")
        sinks.overwrite(newest.select("doc_id", "version"), f"{target}/versions/batch_id={batch_id}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(feed)
    job = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()


def manifest(spark: SparkSession, target: str) -> Row | None:
    """The newest compaction: its base and the last batch that is part of it. None before the first one."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{target}/manifests")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return rows.orderBy(F.desc("upto")).first()


def _live(spark: SparkSession, target: str, part: str) -> DataFrame:
    """Rows of the base and of the batches after it, with their ``batch_id``; older folders are pruned by name."""
    known = manifest(spark, target)
    try:
        rows = spark.read.parquet(f"{target}/{part}").withColumn("batch_id", F.col("batch_id").cast("bigint"))
    except AnalysisException as error:  # a compaction may have left no batch
        if known is None or error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.read.parquet(f"{known.base}/{part}")
    if known is None:
        return rows
    return spark.read.parquet(f"{known.base}/{part}").unionByName(rows.where(F.col("batch_id") > known.upto))


def _last(spark: SparkSession, target: str) -> DataFrame:
    seen = _live(spark, target, "versions")
    return seen.groupBy("doc_id").agg(F.max(F.struct("version", "batch_id")).alias("last")).select("doc_id", "last.*")


def current_chunks(spark: SparkSession, target: str) -> DataFrame:
    """The chunks of each document's newest version, from the last batch that brought it; none if it has no text."""
    return _current(spark, target).drop("batch_id")


def _current(spark: SparkSession, target: str) -> DataFrame:
    return _live(spark, target, "chunks").join(_last(spark, target), ["doc_id", "version", "batch_id"])


def compact(spark: SparkSession, target: str) -> None:
    """Writes the current chunks and versions as a new base, names it in a manifest and removes what it replaces.

    Run it between two syncs. The manifest is the last thing written, so a run that fails before changes nothing for
    readers; folders that it left are removed by the next run. A batch that is retried after it was compacted is
    ignored, as its rows are in the base. Frames that were opened before must be opened again.
    """
    old = manifest(spark, target)
    last = stage(_last(spark, target))
    upto = last.agg(F.max("batch_id")).first()[0]
    if upto is None or (old is not None and upto <= old.upto):
        return
    base = f"{target}/bases/upto={upto}"
    sinks.overwrite(_live(spark, target, "chunks").join(last, ["doc_id", "version", "batch_id"]), f"{base}/chunks")
    sinks.overwrite(last, f"{base}/versions")
    sinks.overwrite(spark.createDataFrame([(base,)], "base string").coalesce(1), f"{target}/manifests/upto={upto}")
    for part in ("chunks", "versions"):
        sinks.remove_folders(spark, f"{target}/{part}", "batch_id=", upto)
    for part in ("bases", "manifests"):
        sinks.remove_folders(spark, f"{target}/{part}", "upto=", upto - 1)
