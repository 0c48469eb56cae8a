"""Near-duplicates by SimHash, found at the anchors of a covering code.

A 64-bit fingerprint holds the majority bits of the hashes of a text's three-word shingles. Two texts link if their
fingerprints differ in at most two bits. The anchors are pairs of words of the perfect 23-bit Golay code, one for bits
0-22 and one for bits 23-45 (the code covers all 23-bit words within radius 3, each by exactly one codeword). Every
distinct fingerprint has one home anchor, and is copied to each anchor whose two halves lie within the covering radius
plus a share of the threshold, the shares summing to at most the threshold. Any linked pair therefore meets at the
home anchor of either end, where full fingerprints are compared.

Equal fingerprints are one node, so thousands of copies cost one row. An anchor with many fingerprints is cut: its
home fingerprints are dealt into blocks of bounded size and each block gets the visitors. A block reports only a
spanning forest of its links, so no pairs of a group are listed, yet no link between different texts is lost.

Defined cases: a null or blank text has fingerprint zero, which links like any other; fewer than three words make one
shingle; a null doc_id keeps its row and counts in no component's name unless all are null; repeated rows give repeated
result rows; other columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, stage_table, texts
from .components import components

THRESHOLD = 2
SEED = 42
BITS, CHECK_BITS, RADIUS = 23, 11, 3
#: Generator polynomial of the Golay code, as bits.
GENERATOR = 0b101011100011
#: Home fingerprints of one block of an anchor, and of one step of a comparison.
#: Home fingerprints and all fingerprints in one comparison at an anchor.
BLOCK, VISITORS = 4_096, 65_536
STEP = 512
SHINGLE_STEP = 2_000_000
Steps = list[tuple[np.ndarray, np.ndarray]]


def shingles(words: list[bytes]) -> Iterator[bytes]:
    if len(words) < 3:
        return iter([b" ".join(words)] if words else [])
    return map(b" ".join, zip(words, words[1:], words[2:]))


def fingerprint(text: bytes) -> int:
    """Majority bits over the shingles of the text; a bit is set if more than half of the hashes set it."""
    digest = xxhash.xxh64_intdigest
    hashes = [digest(s, SEED) for s in shingles(text.lower().split())]
    if not hashes:
        return 0
    ones = np.zeros(64, np.int64)
    values = np.array(hashes, "<u8")
    for start in range(0, len(values), SHINGLE_STEP):
        part = values[start : start + SHINGLE_STEP].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(values), bitorder="little").tobytes(), "little")


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found = np.array([fingerprint(t) for t in texts(batch.column("text"))], np.uint64).view(np.int64)
        names = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(found)], [*names, "print"])


def fingerprints(documents: DataFrame) -> DataFrame:
    """(doc_id, print) of every row; print holds the 64 bits as a long."""
    return documents.select("doc_id", "text").mapInArrow(_prints, "doc_id long, print long")


def syndromes(values: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words divided by the generator polynomial."""
    rest = values.astype(np.int64)
    for bit in range(BITS - 1, CHECK_BITS - 1, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - CHECK_BITS)), rest)
    return rest


def anchor_steps(threshold: int) -> Steps:
    """For each share of the threshold: by syndrome, the steps that lead to the codewords newly in reach.

    A step is an error pattern of the word's syndrome: of weight up to the radius for share 0, of weight radius + share
    for the others. Rows are padded; the second array counts the valid ones.
    """
    words = np.arange(1 << BITS, dtype=np.int32)
    weight = np.bitwise_count(words)
    tables = []
    for share in range(threshold + 1):
        steps = words[weight <= RADIUS] if share == 0 else words[weight == RADIUS + share]
        of = syndromes(steps)
        order = np.argsort(of, kind="stable")
        count = np.bincount(of, minlength=1 << CHECK_BITS)
        padded = np.zeros((1 << CHECK_BITS, count.max()), np.int64)
        column = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        padded[of[order], column] = steps[order]
        tables.append((padded, count))
    return tables


def _reach(half: np.ndarray, padded: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the word and codeword, for every codeword that a step leads to."""
    of = syndromes(half)
    index = np.repeat(np.arange(len(half)), count[of])
    column = np.arange(len(index)) - np.repeat(np.cumsum(count[of]) - count[of], count[of])
    return index, half[index] ^ padded[of[index], column]


def anchors(prints: np.ndarray, steps: Steps) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Index into ``prints``, anchor, and whether it is the home anchor."""
    bits = prints.view(np.uint64)
    mask = np.uint64((1 << BITS) - 1)
    low, high = (bits & mask).astype(np.int64), (bits >> np.uint64(BITS) & mask).astype(np.int64)
    for first in range(len(steps)):
        index, code = _reach(low, *steps[first])
        for second in range(len(steps) - first):
            inner, other = _reach(high[index], *steps[second])
            yield index[inner], code[inner] << BITS | other, first == second == 0


def _replicas(batches: Iterator[pa.RecordBatch], steps: Steps) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 4_096):
            prints = batch.column("print")[start : start + 4_096].to_numpy(zero_copy_only=False)
            for index, anchor, home in anchors(prints, steps):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(prints[index]), pa.array(np.full(len(index), home))], ["anchor", "print", "home"]
                )


def forest(homes: np.ndarray, others: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``homes`` and ``others``."""
    nodes = np.unique(np.concatenate([homes, others]))
    root = np.arange(len(nodes))
    left, right = np.searchsorted(nodes, homes), np.searchsorted(nodes, others)
    edges: list[tuple[int, int]] = []
    homes, others = homes.view(np.uint64), others.view(np.uint64)

    def top(node: int) -> int:
        while root[node] != node:
            root[node] = root[root[node]]
            node = root[node]
        return node

    for start in range(0, len(homes), STEP):
        part = homes[start : start + STEP]
        for offset in range(0, len(others), 8_192):
            near = np.bitwise_count(part[:, None] ^ others[None, offset : offset + 8_192]) <= threshold
            a, b = np.nonzero(near)
            a, b = left[start + a], right[offset + b]
            while len(root) and (root != (up := root[root])).any():
                root = up
            apart = root[a] != root[b]
            for x, y in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
                x_top, y_top = top(x), top(y)
                if x_top != y_top:
                    root[max(x_top, y_top)] = min(x_top, y_top)
                    edges.append((int(nodes[x]), int(nodes[y])))
    return edges


def _links(key: tuple, group: pa.Table, threshold: int) -> pa.Table:
    prints = group.column("print").to_numpy()
    home = group.column("home").to_numpy()
    edges = forest(np.unique(prints[home]), np.unique(prints[~home]), threshold)
    u, v = zip(*edges, strict=True) if edges else ((), ())
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def links(prints: DataFrame, threshold: int = THRESHOLD, block: int = BLOCK, visitors: int = VISITORS) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that connect exactly what links connect.

    At a hot anchor the home fingerprints are dealt into blocks, and so are all fingerprints at it; each pair of blocks is
    one group, of about ``block`` and ``visitors`` rows.
    """
    distinct = prints.select("print").where("print IS NOT NULL").distinct()
    steps = anchor_steps(threshold)
    copies = stage_table(distinct.mapInArrow(lambda b: _replicas(b, steps), "anchor long, print long, home boolean"), "anchors")
    size = copies.groupBy("anchor").agg(F.count_if("home").alias("homes"), F.count("*").alias("all"))
    blocks, shifts = F.ceil(F.col("homes") / block).cast("int"), F.ceil(F.col("all") / visitors).cast("int")
    size = size.where("homes > 0 AND all > 1").select("anchor", blocks.alias("blocks"), shifts.alias("shifts"))
    placed = copies.join(size, "anchor")

    def one(count: str) -> Column:
        return F.pmod(F.xxhash64("print"), F.col(count)).cast("int")

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    homes = placed.where("home").select("anchor", one("blocks").alias("block"), each("shifts").alias("shift"), "print", "home")
    visits = placed.select("anchor", each("blocks").alias("block"), one("shifts").alias("shift"), "print", F.lit(False).alias("home"))
    grouped = homes.union(visits).groupBy("anchor", "block", "shift")
    return grouped.applyInArrow(lambda k, g: _links(k, g, threshold), "u long, v long")


def _rooted(distinct: DataFrame, threshold: int) -> DataFrame:
    """``distinct``, one row of each print, with the root of its component: the smallest print in it."""
    roots = components(links(distinct, threshold))
    tied = distinct.join(roots, distinct["print"] == roots["node"], "left")
    return tied.select(*distinct.columns, F.coalesce("root", "print").alias("root"))


def near_duplicates(documents: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, print, component_id) of every row; component_id is the smallest doc_id of the component."""
    prints = stage_table(fingerprints(documents), "prints")
    tied = _rooted(prints.groupBy("print").agg(F.min("doc_id").alias("smallest")), threshold)
    named = tied.groupBy("root").agg(F.min("smallest").alias("component_id"))
    of = tied.join(named, "root").select("print", "component_id")
    return prints.join(of, "print").select("doc_id", "print", "component_id")
