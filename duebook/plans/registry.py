"""Named queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from duebook.sources.ledger import Ledger

from .common_sql import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, views: tuple[str, ...] = ()):
    """Register a ledger job under ``name``; ``oracle`` is its SQL over ``views`` and the source tables."""

    def register(job: Callable[[Ledger], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return job(Ledger(spark, folder))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = with_views(oracle, *views)
        return job

    return register
