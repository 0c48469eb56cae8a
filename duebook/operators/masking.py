"""Columns masked by the role of the reader, as a policy table says."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.functions.keys import key_digest

POLICY = "role string, column_name string, action string"
SHOW, DIGITS, DIGEST, HIDE = "show", "digits", "digest", "hide"


def _masked(column: str, kind: str, action: Column) -> Column:
    value = F.col(column)
    shown = F.when(action == SHOW, value)
    if kind == "string":
        shown = shown.when(action == DIGITS, F.regexp_replace(value, "[0-9]", "*")).when(action == DIGEST, key_digest(value))
    return shown.alias(column)


def masked(rows: DataFrame, policy: DataFrame, open_columns: Sequence[str] = ()) -> DataFrame:
    """``rows`` as the reader named in their ``role`` column may see them.

    ``policy`` has one action per role and column: show, digits (each digit a star), digest (a stable pseudonym) or hide.
    What the policy does not name is hidden, as is a ``digits`` or ``digest`` of a column that is no string, and every
    column of a null or unknown role; ``open_columns`` are always shown. Two actions for one column: the strictest counts.

    The policy becomes one row per role, so the broadcast grows with the roles, not with the rows.
    """
    strictest = {HIDE: 0, DIGEST: 1, DIGITS: 2, SHOW: 3}
    rank = F.lit(-1)
    for action, place in strictest.items():
        rank = F.when(F.col("action") == action, place).otherwise(rank)
    one = policy.where(F.col("role").isNotNull() & F.col("column_name").isNotNull()).groupBy("role", "column_name")
    one = one.agg(F.min_by("action", F.struct(rank, "action")).alias("action"))
    pairs = F.collect_list(F.struct("column_name", F.coalesce("action", F.lit(HIDE))))
    rules = one.groupBy("role").agg(F.map_from_entries(pairs).alias("_rules"))
    joined = rows.join(F.broadcast(rules), "role", "left")
    kinds = dict(rows.dtypes)
    shown = ["role", *open_columns]
    return joined.select(*[F.col(c) if c in shown else _masked(c, kinds[c], F.col("_rules")[c]) for c in rows.columns])
