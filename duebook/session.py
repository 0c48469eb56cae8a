"""Session settings and the shared folder for staged tables.

A cluster names a folder every executor can reach in ``spark.checkpoint.dir``; staged tables and stream state go
there. Only a local session without that setting gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", name: str = "duebook", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; on a cluster use the session the cluster provides."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a fresh temporary one only for an unset local session."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="duebook-"))
    return context.getCheckpointDir()


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/duebook-{purpose}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there: later passes neither recompute nor diverge."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_files(df: DataFrame, purpose: str) -> DataFrame:
    """``stage`` as Parquet: smaller, and later passes read the columns they need."""
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
