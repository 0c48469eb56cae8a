"""Nearest neighbours of many query vectors in one job, and context blocks for retrieval.

A task compares its batches of the corpus with the query matrix and keeps only its k best per query, so no pair is
ever emitted. Few queries are broadcast; many are laid out in a grid of query blocks and corpus blocks of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duebook.session import stage

MAX_BROADCAST_QUERIES = 4096
GRID_QUERIES, GRID_CORPUS = 2048, 65536
#: Bytes of one matrix of distances.
TILE_BYTES = 1 << 24
#: Hits whose documents are found by a broadcast of their ids.
MAX_BROADCAST_HITS = 1_000_000
RULE = "* * *"
NO_TEXT = "(no text)"
HITS = "query_id string, vec_id bigint, distance double"
ARROW_HITS = pa.schema([("query_id", pa.string()), ("vec_id", pa.int64()), ("distance", pa.float64())])


def distances(corpus: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    """Squared Euclidean distance, or 1 - cosine, of every corpus row to every query, to six digits."""
    dots = corpus @ queries.T
    if metric == "l2":
        d = (corpus**2).sum(axis=1)[:, None] - 2.0 * dots + (queries**2).sum(axis=1)[None, :]
        d = np.maximum(d, 0.0)
    else:
        norms = np.linalg.norm(corpus, axis=1)[:, None] * np.linalg.norm(queries, axis=1)[None, :]
        d = 1.0 - np.divide(dots, norms, out=np.zeros_like(dots), where=norms > 0)
    # a rounded minus zero becomes zero
    return np.round(d, 6) + 0.0


def as_places(groups: np.ndarray) -> np.ndarray:
    """One row of places per entry: a list has several, another value one."""
    return np.stack(groups) if len(groups) and isinstance(groups[0], list | np.ndarray) else groups[:, None]


class BestHits:
    """The k best hits per query, by distance then id, over the batches of one task.

    The corpus is compared in tiles of fixed bytes; of a tile only rows as near as a query's k-th best are kept. Rows and
    queries are compared where their ``match`` is equal or, if it is a list, one of its places; hits lie ``within`` a distance.
    """

    def __init__(self, queries: pd.DataFrame, k: int, metric: str, within: float = np.inf):
        self.names = queries["query_id"].to_numpy()
        self.matrix = np.stack(queries["vector"].to_numpy()).astype("float64")
        self.groups = as_places(queries["match"].to_numpy())
        self.k, self.metric, self.within = k, metric, within
        self.query, self.ids, self.found = np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0)
        self.limit = np.full(len(self.names), np.finfo("float64").max)

    def add(self, ids: np.ndarray, vectors: np.ndarray, groups: np.ndarray) -> None:
        groups = as_places(groups)
        tile = max(1, TILE_BYTES // (8 * len(self.names)))
        for start in range(0, len(ids), tile):
            part = slice(start, start + tile)
            d = distances(vectors[part].astype("float64"), self.matrix, self.metric)
            same = np.zeros(d.shape, bool)
            for place in range(groups.shape[1]):
                same |= groups[part, place, None] == self.groups[None, :, place]
            self._add(ids[part], np.where(same & (d < self.within), d, np.inf))

    def _add(self, ids: np.ndarray, d: np.ndarray) -> None:
        limit = self.limit
        if len(d) > self.k:
            limit = np.minimum(limit, np.partition(d, self.k - 1, axis=0)[self.k - 1])
        rows, query = np.nonzero(d <= limit)
        query = np.concatenate([self.query, query])
        ids, found = np.concatenate([self.ids, ids[rows]]), np.concatenate([self.found, d[rows, query[len(self.query) :]]])
        order = np.lexsort((ids, found, query))
        query = query[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = order[place < self.k]
        last = order[place == self.k - 1]
        self.query, self.ids, self.found = query[place < self.k], ids[kept], found[kept]
        self.limit[query[place == self.k - 1]] = found[last]

    def rows(self) -> pd.DataFrame:
        # plain objects: pandas would make the names an Arrow column, in chunks that a group result may not have
        return pd.DataFrame({"query_id": pd.Series(self.names[self.query], dtype=object), "vec_id": self.ids, "distance": self.found})


def _broadcast_scan(queries: DataFrame, corpus: DataFrame, k: int, metric: str, within: float = np.inf) -> DataFrame:
    # every row: the caller has counted at most MAX_BROADCAST_QUERIES of them
    table = pd.DataFrame([r.asDict() for r in queries.take(MAX_BROADCAST_QUERIES)])
    shared = corpus.sparkSession.sparkContext.broadcast(table)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = BestHits(shared.value, k, metric, within)
        for batch in batches:
            n = batch.num_rows
            if n:
                # the vectors of a batch lie in one buffer
                flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
                groups = batch.column("match").to_numpy(zero_copy_only=False)
                best.add(batch.column("vec_id").to_numpy(), flat.reshape(n, -1), groups)
        hits = best.rows()
        yield pa.RecordBatch.from_pandas(hits, schema=ARROW_HITS, preserve_index=False)

    return corpus.mapInArrow(scan, HITS)


def _grid_scan(queries: DataFrame, corpus: DataFrame, k: int, metric: str, block: tuple[int, int], within: float = np.inf) -> DataFrame:
    """Every query block meets every corpus block once; blocks are even because they are cut by key digest."""
    q_blocks = max(1, -(-queries.count() // block[0]))
    c_blocks = max(1, -(-corpus.count() // block[1]))

    def cell(n: int, key: str):
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.withColumn("q_block", cell(q_blocks, "query_id")).withColumn("c_block", every(c_blocks))
    right = corpus.withColumn("c_block", cell(c_blocks, "vec_id")).withColumn("q_block", every(q_blocks))

    def meet(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({"query_id": pd.Series([], dtype=object), "vec_id": np.zeros(0, "int64"), "distance": np.zeros(0)})
        best = BestHits(q, k, metric, within)
        best.add(c["vec_id"].to_numpy(), np.stack(c["vector"].to_numpy()), c["match"].to_numpy())
        return best.rows()

    keys = ["q_block", "c_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, HITS)


def nearest(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    metric: str = "l2",
    match: Sequence[str] = (),
    max_broadcast: int = MAX_BROADCAST_QUERIES,
    block: tuple[int, int] = (GRID_QUERIES, GRID_CORPUS),
) -> DataFrame:
    """The exact ``k`` nearest corpus rows per query: ``(query_id, place, vec_id, distance)``.

    ``queries(query_id, vector)`` and ``corpus(vec_id, vector)``; ``match`` names columns of both, and only rows with
    the same text in all of them are compared (the metadata filter). A missing value matches missing values only.
    Other conditions on the corpus are a ``where`` on it.
    """
    key = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in match])) if match else F.lit("")
    queries, corpus = (df.withColumn("match", key) for df in (queries, corpus))
    return _best(queries, corpus, k, metric, max_broadcast, block)


def _best(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    metric: str,
    max_broadcast: int = MAX_BROADCAST_QUERIES,
    block: tuple[int, int] = (GRID_QUERIES, GRID_CORPUS),
    within: float = np.inf,
) -> DataFrame:
    """``nearest`` for rows with their ``match``; hits lie below the distance ``within``."""
    queries = stage(queries.select("query_id", "vector", "match"))
    corpus = corpus.select("vec_id", "vector", "match").filter(F.col("vector").isNotNull())
    max_broadcast = min(max_broadcast, MAX_BROADCAST_QUERIES)
    asked = queries.limit(max_broadcast + 1).count()
    if asked == 0:
        hits = corpus.sparkSession.createDataFrame([], HITS)
    elif asked <= max_broadcast:
        hits = _broadcast_scan(queries, corpus, k, metric, within)
    else:
        hits = _grid_scan(queries, corpus, k, metric, block, within)
    # at most k rows per query and task reach this window
    order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return hits.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).select(
        "query_id", "place", "vec_id", "distance"
    )


def centroids(vectors: DataFrame, by: str) -> DataFrame:
    """Mean vector per group, to six digits; sums are per group and dimension before the shuffle."""
    parts = vectors.select(by, F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy(by, "i").agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("m"))
    # one entry per dimension
    packed = means.groupBy(by).agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("p"))
    return packed.select(F.col(by).cast("string").alias("query_id"), F.transform("p", lambda e: e["m"]).alias("vector"))


def context_blocks(hits: DataFrame, documents: DataFrame) -> DataFrame:
    """One text per query: its documents in order of place, with a rule between them; a hit keeps its place without one."""
    hits = stage(hits.select("query_id", "place", "vec_id"))
    # documents without a hit leave before any text is shuffled
    ids = hits.select("vec_id").distinct()
    ids = F.broadcast(ids) if hits.count() <= MAX_BROADCAST_HITS else ids
    named = documents.select(F.col("doc_id").alias("vec_id"), "lang", "source", "text").join(ids, "vec_id", "left_semi")
    found = hits.join(named, "vec_id", "left")
    number, name = F.concat(F.lit("#"), F.col("place").cast("string")), F.concat(F.lit("document "), F.col("vec_id").cast("string"))
    block = F.concat_ws("\n", F.concat_ws(" | ", number, name, "source", "lang"), F.coalesce("text", F.lit(NO_TEXT)))
    # k documents per query
    listed = found.select("query_id", "place", block.alias("block")).groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "block"))).alias("blocks")
    )
    text = F.array_join(F.transform("blocks", lambda b: b["block"]), f"\n{RULE}\n")
    return listed.select("query_id", F.size("blocks").alias("n_documents"), text.alias("context"))


def cell_search(queries: DataFrame, corpus: DataFrame, k: int, cells: int, probes: int, block: int = GRID_CORPUS) -> tuple[DataFrame, DataFrame]:
    """Approximate nearest rows by squared distance: each query meets only the ``probes`` cells whose centres are nearest.

    Cells are k-means clusters of the whole corpus; a large cell is cut into blocks of about ``block`` rows. Gives the
    hits ``(query_id, place, vec_id, distance)`` and ``(query_id, n_candidates)``, the rows each query was compared with.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rows = corpus.select("vec_id", F.col("vector").cast("array<double>").alias("vector")).where("vector IS NOT NULL")
    dense = rows.withColumn("dense", array_to_vector("vector"))
    model = KMeans(k=cells, seed=42, maxIter=10, featuresCol="dense", predictionCol="cell").fit(dense)
    placed = stage(model.transform(dense).select("vec_id", "vector", "cell"))
    # one row per cell
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
    sizes = F.broadcast(sizes.withColumn("blocks", F.ceil(F.col("size") / block).cast("int")))
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in centre]) for centre in model.clusterCenters()])
    far = F.transform(
        "centres",
        lambda c, i: F.struct(F.aggregate(F.zip_with("vector", c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x).alias("d"), i.alias("cell")),
    )
    asked = queries.select("query_id", "vector", centres.alias("centres"))
    near = F.slice(F.array_sort(far), 1, probes)
    routed = stage(asked.select("query_id", "vector", F.explode(near).alias("near")).select("query_id", "vector", F.col("near.cell").alias("cell")).join(sizes, "cell"))
    left = routed.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = placed.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int"))

    def meet(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({"query_id": pd.Series([], dtype=object), "vec_id": np.zeros(0, "int64"), "distance": np.zeros(0)})
        best = BestHits(q.assign(match=""), k, "l2")
        best.add(c["vec_id"].to_numpy(), np.stack(c["vector"].to_numpy()), np.full(len(c), "", object))
        return best.rows()

    keys = ["cell", "part"]
    left, right = left.select(*keys, "query_id", "vector"), right.select(*keys, "vec_id", "vector")
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, HITS)
    order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    best = hits.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    candidates = routed.groupBy("query_id").agg(F.sum("size").alias("n_candidates"))
    return best.select("query_id", "place", "vec_id", "distance"), candidates


def cell_recall(queries: DataFrame, corpus: DataFrame, exact: DataFrame, k: int, cells: int, probes: int) -> DataFrame:
    """Per query: exact neighbours, those that the cells find, and how many rows were compared of how many."""
    hits, candidates = cell_search(queries, corpus, k, cells, probes)
    matched = exact.join(hits.select("query_id", "vec_id", F.lit(1).alias("found")), ["query_id", "vec_id"], "left")
    counts = matched.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_exact"), F.count("found").alias("n_found"))
    whole = corpus.where("vector IS NOT NULL").agg(F.count(F.lit(1))).scalar()
    return counts.join(candidates, "query_id").select(
        "*", whole.alias("n_vectors"), F.round(F.col("n_found") / F.col("n_exact"), 4).alias("recall")
    )


def lsh_recall(vectors: DataFrame, queries: DataFrame, exact: DataFrame, k: int, threshold: float) -> DataFrame:
    """Share of the exact neighbours that random-projection hashing finds, per query.

    A row is compared with the queries that share one of its hashes, where it lies: each task keeps its k best per query,
    so candidate pairs are never shuffled; rows are, once, as equal ones count once.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector, vector_to_array

    def dense(frame: DataFrame, key: str) -> DataFrame:
        return frame.select(key, "vector", array_to_vector(F.col("vector").cast("array<double>")).alias("v"))

    rows = vectors.select("vec_id", "vector").where("vector IS NOT NULL")
    asked = queries.select("query_id", "vector").distinct()
    model = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=1.0, numHashTables=6, seed=42).fit(dense(rows, "vec_id"))
    # one number per hash table
    hashes = F.array(*[vector_to_array(F.col("h")[i])[0] for i in range(6)]).alias("match")
    rows = model.transform(dense(rows.distinct(), "vec_id")).select("vec_id", "vector", hashes)
    asked = model.transform(dense(asked, "query_id")).select("query_id", "vector", hashes)
    best = _best(asked, rows, k, "l2", within=threshold**2).select("query_id", "vec_id")
    matched = exact.join(best.withColumn("found", F.lit(1)), ["query_id", "vec_id"], "left")
    return matched.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n_exact"),
        F.count("found").alias("n_found"),
        F.round(F.count("found") / F.count(F.lit(1)), 4).alias("recall"),
    )
