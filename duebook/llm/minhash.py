"""Near-duplicates by bottom-k sketches from one hash function.

A document's set holds the hashes of its distinct three-word shingles; a sketch is the smallest k of them (the whole
set, where that is smaller). Documents of equal sets are one node, so thousands of copies cost one row. Two nodes link if
the Jaccard similarity of their sets reaches ``PERCENT``.

1. Inverted lists over the smallest ``RETAINED`` values alone count, for each node, how many of them any other node
   holds. Similar nodes share most of them, so a node that shares too few is left out at once; most texts go here.
2. The sets of the others are built once more and kept. Their ``LISTED`` smallest values are ordered by rarity. Two
   sketches that overlap enough share a value among their first few, so only that prefix gets inverted lists. Values of
   passages that many texts hold come last in the order.
3. In each list every node is paired with the one whose rare values run out first (the plainest copy). Verified links
   join nodes to components. Lists that still touch several components then pair the nodes of different components,
   in blocks; sizes and places in the prefix leave out pairs whose overlap cannot suffice.
4. For each pair the sketch of the union (``SKETCH`` values) estimates the similarity; where a sketch is not the whole
   set, an estimate within five standard deviations of the threshold passes. Whole sets then decide each link exactly.

The overlaps that 1 and 2 ask for lie five standard deviations below what similar sets share (exact bounds where the
sketches are whole sets), so a link at the very threshold is missed about once in a million.

Defined cases: a null or blank text has an empty set and links with nothing; fewer than three words make one shingle; a
null doc_id keeps its row and names a component only if it has no other; repeated rows give repeated result rows; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import key_filter, slices, stage_table, texts
from .components import components

PERCENT = 85
SEED = 42
WORDS = 3
RETAINED, LISTED, SKETCH = 32, 1_024, 256
DEVIATIONS = 5.0
#: Nodes of one block of an inverted list.
BLOCK = 4_096


def shingle_hashes(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles; fewer words than a shingle make one."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.int64)
    if len(found) < words:
        grams = {b" ".join(found)}
    else:
        grams = set(map(b" ".join, zip(*(found[i:] for i in range(words)))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, SEED) for g in grams), np.uint64, len(grams)).view(np.int64)
    return np.unique(hashes)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, np.concatenate(rows) if rows else np.zeros(0, np.int64))


def _sketches(batches: Iterator[pa.RecordBatch], size: int, words: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        sets = [shingle_hashes(t, words) for t in texts(batch.column("text"))]
        nodes = pa.array([xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary())
        sizes = pa.array([len(s) for s in sets], pa.int64())
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*map(batch.column, names), nodes, sizes, _lists([s[:size] for s in sets])], [*names, "node", "n", "sketch"])


def sketches(documents: DataFrame, size: int = RETAINED, words: int = WORDS) -> DataFrame:
    """(doc_id, node, n, sketch) of every row: ``node`` names the set, null if it is empty."""
    schema = "doc_id long, node binary, n long, sketch array<long>"
    return documents.select("doc_id", "text").mapInArrow(lambda b: _sketches(b, size, words), schema)


def least_overlap(percent: int, size: int) -> tuple[int, Column]:
    """How many of its ``size`` retained values a node of ``n`` shares at least with any similar node.

    A whole set shares ``percent`` of itself; a similar set may be larger by 100 / percent and lose what lies beyond its
    own smallest ``size``. A sample falls short of the mean by chance, without replacement from a union of n * 100 /
    percent at most.
    """
    share = percent / 100
    whole = math.floor(size * (1 - (1 - share) / share))
    spare = 1 - F.lit(size * share) / F.col("n")
    sampled = F.floor(size * share - DEVIATIONS * F.sqrt(size * share * (1 - share) * F.greatest(spare, F.lit(0.0))))
    exact = F.least(F.ceil(F.col("n") * percent / 100), F.lit(whole))
    return whole, F.greatest(F.when(F.col("n") <= size, exact).otherwise(F.least(sampled, F.lit(whole))), F.lit(1)).cast("int")


def promising(nodes: DataFrame, percent: int, retained: int) -> DataFrame:
    """Nodes that share enough of their smallest values with any others to have a partner at all."""
    few = nodes.select("node", "n", F.explode(F.slice("sketch", 1, retained)).alias("value"))
    common = few.groupBy("value").agg(F.count("*").alias("owners")).where("owners > 1").select("value")
    shared = few.join(common, "value").groupBy("node", "n").agg(F.count("*").alias("shared"))
    _, needed = least_overlap(percent, retained)
    return shared.where(F.col("shared") >= needed).select("node")


def inverted(nodes: DataFrame, percent: int, size: int) -> DataFrame:
    """(value, node, n, held, needed, place): the prefix of each sketch in order of rarity, without lone values.

    ``held`` values make the sketch, of which any similar node shares ``needed``; ``place`` counts the rarer ones.
    """
    _, needed = least_overlap(percent, size)
    values = nodes.select("node", "n", F.explode(F.slice("whole", 1, size)).alias("value"))
    owners = values.groupBy("value").agg(F.count("*").alias("owners")).where("owners > 1")
    known = values.join(owners, "value").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("owners", "value"))).alias("known"))
    held = F.least(F.col("n"), F.lit(size)).cast("int")
    known = known.withColumn("held", held).withColumn("needed", needed).withColumn("alone", F.col("held") - F.size("known"))
    places = F.posexplode(F.slice("known", F.lit(1), F.greatest(F.col("held") - F.col("needed") + 1 - F.col("alone"), F.lit(0))))
    placed = known.select("node", "n", "held", "needed", "alone", places.alias("rank", "of"))
    return placed.select("of.value", "node", "n", "held", "needed", (F.col("alone") + F.col("rank")).alias("place"))


def _can_link(percent: int, size: int) -> Column:
    """Whether sizes and the rarer values before a shared one still allow a link between ``a`` and ``b``."""
    small, large = F.least("a.n", "b.n"), F.greatest("a.n", "b.n")
    left = F.least(F.col("a.held") - F.col("a.place"), F.col("b.held") - F.col("b.place"))
    whole = F.when(large <= size, F.ceil((F.col("a.n") + F.col("b.n")) * percent / (100 + percent))).otherwise(F.lit(1))
    return (small * 100 >= large * percent) & (left >= F.greatest("a.needed", "b.needed", whole))


def plain_pairs(lists: DataFrame, percent: int, size: int) -> DataFrame:
    """Each node of a list with the one of least place: a pair per row."""
    first = F.min(F.struct("place", "n", "node", "held", "needed")).alias("first")
    pivots = lists.groupBy("value").agg(first, F.count("*").alias("owners")).where("owners > 1").select("value", "first.*")
    a, b = lists.alias("a"), pivots.alias("b")
    joined = a.join(b, F.col("a.value") == F.col("b.value")).where(F.col("a.node") != F.col("b.node")).where(_can_link(percent, size))
    return joined.select(F.least("a.node", "b.node").alias("u"), F.greatest("a.node", "b.node").alias("v")).distinct()


def open_pairs(lists: DataFrame, roots: DataFrame, percent: int, size: int, block: int = BLOCK) -> DataFrame:
    """Pairs of nodes of different components in the lists that touch several, each list in blocks."""
    known = lists.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ends = known.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("owners"))
    several = ends.where("low <> high").select("value", F.ceil(F.col("owners") / block).cast("int").alias("blocks"))
    rows = stage_table(known.join(several, "value"), "open-lists")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    a = rows.withColumn("block", own).alias("a")
    b = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).alias("b")
    same = (F.col("a.value") == F.col("b.value")) & (F.col("a.block") == F.col("b.block"))
    apart = (F.col("a.node") < F.col("b.node")) & (F.col("a.root") != F.col("b.root"))
    joined = a.join(b, same).where(apart & _can_link(percent, size))
    return joined.select(F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct()


def _similar(both: Column, n_u: Column, n_v: Column, percent: int) -> Column:
    return both * 100 >= (n_u + n_v - both) * percent


def verified(pairs: DataFrame, nodes: DataFrame, percent: int, size: int) -> DataFrame:
    """The pairs that link: the union's sketch sifts them, whole sets decide."""
    sides = [nodes.select("node", "n", "sketch").toDF(end, f"n_{end}", f"s_{end}") for end in "uv"]
    both = F.array_intersect("s_u", "s_v")
    # The smallest values of both sketches together are the sketch of the union.
    union = F.slice(F.array_sort(F.array_union("s_u", "s_v")), 1, size)
    whole = F.greatest("n_u", "n_v") <= size
    exact = _similar(F.size(both), F.col("n_u"), F.col("n_v"), percent)
    share, spread = percent / 100, DEVIATIONS * math.sqrt(percent * (100 - percent) / size) / 100
    estimate = F.size(F.array_intersect(union, both)) >= math.floor((share - spread) * size)
    joined = pairs.join(sides[0], "u").join(sides[1], "v")
    sifted = stage_table(joined.where(F.when(whole, exact).otherwise(estimate)).select("u", "v", "n_u", "n_v", whole.alias("whole")), "sifted")
    sets = [nodes.where(F.col("n") > size * percent // 100).select("node", "whole").toDF(end, f"set_{end}") for end in "uv"]
    long_pairs = sifted.where("NOT whole").join(sets[0], "u").join(sets[1], "v")
    long_pairs = long_pairs.where(_similar(F.size(F.array_intersect("set_u", "set_v")), F.col("n_u"), F.col("n_v"), percent))
    return sifted.where("whole").select("u", "v").union(long_pairs.select("u", "v"))


def whole_sets(documents: DataFrame, nodes: DataFrame, size: int, words: int) -> DataFrame:
    """(node, n, sketch, whole) of ``nodes`` (node, doc_id), from the texts of one row each."""
    # Rows that pass by chance go with their sets, below.
    rows = documents.select("doc_id", "text").where(key_filter(nodes.select("doc_id"))(F.col("doc_id")))
    sets = sketches(rows, (1 << 31) - 1, words).join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"])
    return sets.select("node", "n", F.slice("sketch", 1, size).alias("sketch"), F.col("sketch").alias("whole"))


def node_links(documents: DataFrame, rows: DataFrame, percent: int, words: int, block: int) -> DataFrame:
    """(node, root) of every node that links with another; ``rows`` are the documents' sketches of ``RETAINED`` values."""
    known = rows.where("node IS NOT NULL").groupBy("node", "n", "sketch").agg(F.min("doc_id").alias("doc_id"))
    known = stage_table(known, "known")
    chosen = stage_table(known.join(promising(known, percent, RETAINED), "node").select("node", "doc_id"), "promising")
    nodes = stage_table(whole_sets(documents, chosen, SKETCH, words), "nodes")
    lists = stage_table(inverted(nodes, percent, LISTED), "lists")
    edges = stage_table(verified(plain_pairs(lists, percent, LISTED), nodes, percent, SKETCH), "links")
    roots = components(edges)
    more = stage_table(verified(open_pairs(lists, roots, percent, LISTED, block), nodes, percent, SKETCH), "links")
    return roots if more.isEmpty() else components(edges.union(more))


def near_duplicates(documents: DataFrame, percent: int = PERCENT, words: int = WORDS, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; component_id is the smallest doc_id of the component."""
    rows = stage_table(sketches(documents, RETAINED, words), "sketches")
    roots = node_links(documents, rows, percent, words, block)
    ids = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("smallest"))
    tied = ids.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = tied.groupBy("root").agg(F.min("smallest").alias("component_id"))
    of = tied.join(named, "root").select("node", "component_id")
    found = rows.select("doc_id", "n", "node").join(of, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
