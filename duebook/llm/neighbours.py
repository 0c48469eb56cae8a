"""Approximate nearest neighbours by randomly rotated one-bit codes.

Unit vectors are padded and turned by a random orthogonal matrix; a vector's code is the sign of each turned
coordinate, packed into bits, beside its norm and the correction scalar <code, vector>. Codes are made once for every
row and stored with it. A query's turned coordinates are rounded to ``LEVELS`` and laid out as bit planes, so that its
inner product with the signs of a code is a weighted sum of counts of common bits. Divided by the correction, that
estimates the true inner product without bias; its error is bounded with high probability by ``SPREAD`` times the
deviation that the correction leaves and the rounding adds. Candidates are the vectors whose upper bound reaches the
k-th best lower bound; only those are scored on the original vectors, in double precision.

The index covers every row and lies in hashed blocks of bounded size; queries lie in blocks too, and each pair of
blocks is one task, which returns k rows per query. No bucket, cell or link is skipped, so the bound alone decides the
recall. Vectors stay beside their codes, because the bound leaves many to score (a quarter of the test vectors, which
hardly cluster): fetching those for each query would move more than the vectors of a block.

Defined cases: vectors that are null, zero, of another length than most, or hold null or non-finite components take no
part; a query is never its own neighbour, and rows that repeat its vec_id are not either; repeated rows of a candidate
count once; equal scores go to the smaller vec_id; fewer candidates than k give fewer rows; a null vec_id takes no
part; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table

BITS = 256
SPREAD = 2.4
SEED = 20_240_521
QUERY_BLOCK, VECTOR_BLOCK = 4_096, 8_192
#: Bits to which a turned coordinate of a query is rounded.
PLANES = 4
LEVELS = 1 << PLANES
RESULT = "query_id long, vec_id long, score double"
INDEX = "id long, vector array<double>, code binary, norm double, correction double"


def rotation(dimension: int, bits: int = BITS) -> np.ndarray:
    """``dimension`` orthonormal rows of ``bits`` columns: the part of a random rotation that padded vectors see."""
    square = np.random.default_rng(SEED).standard_normal((bits, bits))
    return np.linalg.qr(square)[0][:dimension]


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, norms and correction scalars."""
    norms = np.sqrt((vectors * vectors).sum(1))
    turned = (vectors / norms[:, None]) @ turn
    return np.packbits(turned > 0, axis=1), norms, np.abs(turned).sum(1) / math.sqrt(turn.shape[1])


class Codes:
    """The codes of a block, as one column of 64-bit words after the other."""

    def __init__(self, codes: np.ndarray, norms: np.ndarray, corrections: np.ndarray) -> None:
        self.bits = codes.shape[1] * 8
        self.words = np.ascontiguousarray(codes).view(np.uint64).T.copy()
        self.ones = np.bitwise_count(self.words).sum(0, dtype=np.int64)
        self.scale = norms / (corrections * math.sqrt(self.bits))
        self.spread = norms * np.sqrt(np.maximum(0, 1 / corrections**2 - 1) / (self.bits - 1))

    def estimate(self, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner products with one turned query, and their error bounds."""
        low, high = turned.min(), turned.max()
        step = (high - low) / (LEVELS - 1) or 1.0
        levels = np.rint((turned - low) / step).astype(np.uint8)
        rounded = low + step * levels
        common = np.zeros(self.words.shape[1], np.int32)
        for plane in range(PLANES):
            own = np.packbits((levels >> plane) & 1).view(np.uint64)
            counts = np.zeros(self.words.shape[1], np.uint16)
            for word, mine in zip(self.words, own, strict=True):
                counts += np.bitwise_count(word & mine)
            common += counts.astype(np.int32) << plane
        signed = 2 * (step * common + low * self.ones) - rounded.sum()
        # the correction's deviation and that of the rounding do not depend on each other
        deviation = np.hypot(math.sqrt(turned @ turned) * self.spread, self.scale * math.sqrt(((turned - rounded) ** 2).sum()))
        return signed * self.scale, SPREAD * deviation


def exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products, summed in the order of the components."""
    total = np.zeros(len(vectors))
    for place in range(len(query)):
        total += vectors[:, place] * query[place]
    return total


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, codes: Codes, turn: np.ndarray, k: int) -> Iterator[tuple]:
    """(query_id, vec_ids, scores) of each query against one block."""
    for query_id, query, turned in zip(query_ids, queries, queries @ turn, strict=True):
        guess, width = codes.estimate(turned)
        others = ids != query_id
        low = np.where(others, guess - width, -np.inf)
        cut = np.partition(low, -k)[-k] if len(low) > k else -np.inf
        chosen = np.flatnonzero((guess + width >= cut) & others)
        scores = exact(query, vectors[chosen])
        top = best(ids[chosen], scores, k)
        yield query_id, ids[chosen][top], scores[top]


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0)


def usable(frame: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector) with double components, one row per key, of the commonest length."""
    rows = frame.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & _usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("length")).count().orderBy(F.desc("count"), "length").first()
    rows = rows.where(F.size("vector") == (lengths["length"] if lengths else 0))
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def with_codes(rows: DataFrame, turn: np.ndarray) -> DataFrame:
    """(id, vector) with the code of each vector."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = np.array(batch.column("vector").flatten()).reshape(batch.num_rows, -1)
                codes, norms, corrections = encode(vectors, turn)
                columns = [*batch.columns, pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norms), pa.array(corrections)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "vector", "code", "norm", "correction"])

    return rows.mapInArrow(add, INDEX)


def _codes(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(rows.num_rows, -1)


def nearest(corpus: DataFrame, queries: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding", bits: int = BITS) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of each query's vector over the corpus."""
    rows_used = usable(corpus, key, vector)
    first = rows_used.select(F.size("vector").alias("n")).first()
    dimension = first.n if first else 1
    # whole 64-bit words
    turn = rotation(dimension, -(-max(bits, dimension) // 64) * 64)
    base = stage_table(with_codes(rows_used, turn), "index")
    asked = queries.select(F.col(key).cast("long").alias("id")).distinct().join(base.select("id", "vector"), "id")
    asked = stage_table(asked, "queries")
    total, n_queries = base.count(), asked.count()
    if not total or not n_queries:
        return asked.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows, columns = math.ceil(n_queries / QUERY_BLOCK), math.ceil(total / VECTOR_BLOCK)

    def place(frame: DataFrame, own: int, other: int, names: tuple[str, str]) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        return frame.select(F.pmod(F.xxhash64("id"), F.lit(own)).cast("int").alias(names[0]), every.alias(names[1]), *frame.columns).groupBy("row", "column")

    def search(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        found = ([], [], [])
        if left.num_rows and right.num_rows:
            a, b = (np.array(t.column("vector").combine_chunks().flatten()).reshape(t.num_rows, -1) for t in (left, right))
            codes = Codes(_codes(right), *(right.column(name).to_numpy() for name in ("norm", "correction")))
            for query_id, ids, scores in search_block(left.column("id").to_numpy(), a, right.column("id").to_numpy(), b, codes, turn, k):
                found[0].append(np.full(len(ids), query_id))
                found[1].append(ids)
                found[2].append(scores)
        whole = [np.concatenate(f) if f else np.array([], np.int64) for f in found]
        return pa.table({"query_id": pa.array(whole[0], pa.int64()), "vec_id": pa.array(whole[1], pa.int64()), "score": pa.array(whole[2].astype(float))})

    left = place(asked, rows, columns, ("row", "column"))
    right = place(base, columns, rows, ("column", "row"))
    hits = left.cogroup(right).applyInArrow(search, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def recall(found: DataFrame, truth: DataFrame) -> float:
    """Share of the true (query_id, vec_id) rows that were found."""
    hit = truth.join(found.select("query_id", "vec_id"), ["query_id", "vec_id"], "left_semi").count()
    return hit / max(1, truth.count())
