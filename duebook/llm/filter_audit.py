"""Interaction of filters: what each filter removes in every order of applying them, by a recursive CTE.

Each document gets a mask of the filters it fails. A mask depends on the text alone, but for repetition, which compares
doc_ids; so documents are first counted per text and part, and repetition is decided between the few rows of a text.
Masks are then counted into cells (part, mask), at most 2^filters a part. For every set of applied filters a cell tells
how many documents are left. The recursive CTE begins with the empty prefix and extends each prefix by every letter it
does not use yet, joining the cell of the bits applied so far; each level emits the metrics of its step. The orders are
the prefixes of full length; their steps are looked up by prefix.

Defined cases: a null text is empty and equals other empty texts; a null source counts as the empty part; a null doc_id
repeats nothing, is repeated by nothing and has no labels; of rows with one doc_id and one text all or none repeat
another; several label rows of a document count as their maximum; other columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stage_table, texts

LETTERS = "ABCDE"
REPEATS = 1 << LETTERS.index("E")
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 2
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
SIGNS = b"#$%&*|"
FOLLOWERS = bytes(range(0x80, 0xC0))


def text_mask(text: bytes) -> int:
    """Bits of the filters that the text alone fails: short, repetitive, shouting, signs."""
    words = text.split()
    short = len(words) < MIN_WORDS
    dull = 100 * len(set(words)) < DISTINCT_PERCENT * len(words)
    points = len(text) - (0 if text.isascii() else len(text) - len(text.translate(None, FOLLOWERS)))
    loud = 100 * (len(text) - len(text.translate(None, CAPITALS))) > CAPITAL_PERCENT * points
    signs = len(text.translate(None, SIGNS)) < len(text)
    return short | dull << 1 | loud << 2 | signs << 3


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        raw = texts(batch.column("text"))
        same = pa.array([blake2b(t, digest_size=16).digest() for t in raw], pa.binary())
        masks = pa.array([text_mask(t) for t in raw], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("source"), same, masks], ["doc_id", "part", "same", "mask"])


def masks(documents: DataFrame) -> DataFrame:
    """(doc_id, part, same, mask) of every row: ``same`` tells equal texts, the mask leaves repetition open."""
    part = F.coalesce(F.col("source"), F.lit("")).alias("source")
    return documents.select("doc_id", part, "text").mapInArrow(_masks, "doc_id long, part string, same binary, mask int")


def cells(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, docs, good, toxic): documents by the filters they fail."""
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    rows = masks(documents).join(marks, "doc_id", "left")
    sums = [F.count("*").alias("docs"), F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("toxic") == 1).alias("toxic")]
    per_id = rows.groupBy("same", "part", "mask", "doc_id").agg(*sums)
    names = ["docs", "good", "toxic"]
    # Rows of the smallest doc_id of a text and part are kept apart from the rest, so a text leaves few rows.
    totals = [F.sum(c).alias(c) for c in names]
    missing = [F.sum(F.when(F.col("doc_id").isNull(), F.col(c)).otherwise(0)).alias(f"idless_{c}") for c in names]
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", *names))).alias("first")
    per_text = stage_table(per_id.groupBy("same", "part", "mask").agg(first, *totals, *missing), "texts")
    smallest = per_text.groupBy("same").agg(F.min("first.doc_id").alias("smallest"))
    joined = per_text.join(smallest, "same")
    own = F.when(F.col("first.doc_id") == F.col("smallest"), 1).otherwise(0)
    left = {c: F.col(f"idless_{c}") + F.when(own == 1, F.col(f"first.{c}")).otherwise(0) for c in names}
    kept = F.struct(F.col("mask"), *[left[c].alias(c) for c in names])
    gone = F.struct(F.col("mask").bitwiseOR(REPEATS).alias("mask"), *[(F.col(c) - left[c]).alias(c) for c in names])
    both = joined.select("part", F.explode(F.array(kept, gone)).alias("cell")).select("part", "cell.*")
    return both.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in names])


def left_after(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """For each part and set of applied filters: documents left, and of those the ones each remaining filter fails."""
    applied = F.explode(F.sequence(F.lit(0), F.lit((1 << len(letters)) - 1))).alias("applied")
    spread = cells.select("*", applied)
    stays = F.col("mask").bitwiseAND(F.col("applied")) == 0
    names = ["docs", "good", "toxic"]
    return spread.groupBy("part", "applied").agg(*[F.sum(F.when(stays, F.col(c)).otherwise(0)).alias(c) for c in names])


WALK = """
WITH RECURSIVE walk (part, prefix, step, bits, letter, kept, good, toxic, removed, good_lost, toxic_lost) AS (
    SELECT part, '', 0, 0, '', docs, good, toxic, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT)
    FROM {{cells}} WHERE applied = 0
    UNION ALL
    SELECT w.part, concat(w.prefix, w.l.letter), w.step + 1, w.bits | w.l.bit, w.l.letter, c.docs, c.good, c.toxic,
        w.kept - c.docs, w.good - c.good, w.toxic - c.toxic
    FROM (
        SELECT *, explode(filter({letters}, x -> bits & x.bit = 0)) AS l FROM walk
    ) w JOIN {{cells}} c ON c.part = w.part AND c.applied = w.bits | w.l.bit
)
SELECT * FROM walk WHERE step > 0
"""


def walk(left: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Every prefix of distinct letters with the metrics of its last step, one level of recursion a step."""
    spark = left.sparkSession
    # Parts times prefixes may pass the default limit on rows of a recursion, which guards against endless ones.
    spark.conf.set("spark.sql.cteRecursionRowLimit", -1)
    alphabet = ", ".join(f"struct('{letter}' AS letter, {1 << i} AS bit)" for i, letter in enumerate(letters))
    return spark.sql(WALK.format(letters=f"array({alphabet})"), cells=left)


def audit(documents: DataFrame, labels: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of all filters and step."""
    found = stage_table(cells(documents, labels), "cells")
    left = stage_table(left_after(found, letters), "left")
    steps = stage_table(walk(left, letters), "walk")
    bit = [F.when(F.col("letter") == letter, 1 << i) for i, letter in enumerate(letters)]
    bit = F.coalesce(*bit)
    orders = steps.where(F.col("step") == len(letters)).select("part", F.col("prefix").alias("filter_order"))
    fails = found.select("part", F.explode(F.array(*[F.struct(F.lit(x).alias("letter"), F.lit(1 << i).alias("bit")) for i, x in enumerate(letters)])).alias("of"), "mask", "docs")
    fails = fails.groupBy("part", F.col("of.letter").alias("letter")).agg(
        F.sum(F.when(F.col("mask").bitwiseAND(F.col("of.bit")) > 0, F.col("docs")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("mask") == F.col("of.bit"), F.col("docs")).otherwise(0)).alias("unique_fails"),
    )
    # A prefix of k letters begins (letters - k)! of the orders.
    begins = F.element_at(F.array(*[F.lit(math.factorial(len(letters) - k)) for k in range(1, len(letters) + 1)]), F.col("step"))
    shapley = steps.groupBy("part", "letter").agg(F.sum(F.col("removed") * begins).alias("shapley"))
    cut = orders.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
    cut = cut.withColumn("prefix", F.expr("left(filter_order, step)"))
    joined = cut.join(steps.drop("step"), ["part", "prefix"]).join(fails, ["part", "letter"]).join(shapley, ["part", "letter"])
    return joined.select(
        "part", "filter_order", "step", "kept", "removed", (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails", "good_lost", "toxic_lost", "shapley",
    )
