"""Joins of many rows to one row per key, where a few keys may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 16


def salted_lookup(facts: DataFrame, dim: DataFrame, key: str, spread: Column, salts: int = SALTS) -> DataFrame:
    """Inner join on ``key`` with the rows of one key spread over ``salts`` tasks; ``dim`` is repeated that often.

    Worth it where ``dim`` is much smaller than ``facts``. AQE may still split a task that stays large, and may
    broadcast ``dim`` once its measured size allows.
    """
    salted = facts.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    repeated = dim.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [key, "__salt"]).drop("__salt")
