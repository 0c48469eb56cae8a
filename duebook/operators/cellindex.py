"""A stored index of vectors in k-means cells whose distance bounds say which rows can still be among the nearest.

A row keeps its distance to the centre of its cell (``residual``). By the triangle inequality a row is at least
``|d(query, centre) - residual|`` away from a query. A first pass looks into the nearest cells and gives each query the
distance of its k-th hit so far; the second pass compares only rows whose bound is not above that. So the result is
exact, and the share of rows compared depends on how well the vectors cluster.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duebook.operators.vectors import GRID_CORPUS, GRID_QUERIES, HITS, BestHits
from duebook.session import stage

MAX_CELLS = 4096
#: Distances are rounded to six digits; bounds leave room for that.
MARGIN = 1e-5
COMPARED = HITS + ", n_compared bigint"
EMPTY = {"query_id": pd.Series([], dtype=object), "vec_id": np.zeros(0, "int64"), "distance": np.zeros(0), "n_compared": np.zeros(0, "int64")}


@dataclass(frozen=True)
class CellIndex:
    """``root/rows`` holds (vec_id, vector, residual), a folder per cell and ordered by residual; ``root/cells`` one row
    per cell: its centre, how many rows it has, and their smallest and largest residual."""

    spark: SparkSession
    root: str

    def build(self, corpus: DataFrame, cells: int, seed: int = 42) -> None:
        """Writes the index of every ``corpus(vec_id, vector)`` row with a vector."""
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        if not 1 <= cells <= MAX_CELLS:
            raise ValueError(f"1 to {MAX_CELLS} cells")
        rows = stage(corpus.select("vec_id", F.col("vector").cast("array<double>").alias("vector")).where("vector IS NOT NULL"))
        dense = rows.withColumn("dense", array_to_vector("vector"))
        if rows.isEmpty():
            raise ValueError("no vectors to index")
        model = KMeans(k=cells, seed=seed, maxIter=10, featuresCol="dense", predictionCol="cell").fit(dense)
        # one entry per cell
        centres = F.array(*[F.array(*[F.lit(float(x)) for x in centre]) for centre in model.clusterCenters()])
        squares = F.zip_with("vector", F.element_at(centres, F.col("cell") + 1), lambda a, b: (a - b) * (a - b))
        residual = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x)).alias("residual")
        placed = model.transform(dense).select("vec_id", "vector", "cell", residual)
        placed.hint("rebalance", "cell").sortWithinPartitions("cell", "residual").write.mode("overwrite").partitionBy("cell").parquet(f"{self.root}/rows")
        known = [(i, [float(x) for x in centre]) for i, centre in enumerate(model.clusterCenters())]
        named = F.broadcast(self.spark.createDataFrame(known, "cell int, centre array<double>"))
        sizes = self.rows().groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.min("residual").alias("low"), F.max("residual").alias("high"))
        sizes.join(named, "cell").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/cells")

    def rows(self) -> DataFrame:
        return self.spark.read.schema("vec_id bigint, vector array<double>, residual double, cell int").parquet(f"{self.root}/rows")

    def _cells(self) -> pd.DataFrame:
        # at most MAX_CELLS rows
        rows = self.spark.read.parquet(f"{self.root}/cells").orderBy("cell").take(MAX_CELLS)
        return pd.DataFrame([r.asDict() for r in rows])

    def _compare(self, routed: DataFrame, cells: pd.DataFrame, k: int) -> DataFrame:
        """The k best hits of each row ``(query_id, vector, cell, d, within)`` among its cell's rows, and how many rows
        its bound let through. A cell with many rows or queries is cut into blocks of fixed size."""
        asked = routed.groupBy("cell").agg(F.count(F.lit(1)).alias("asked")).take(MAX_CELLS)
        if not asked:
            return self.spark.createDataFrame([], COMPARED)
        sizes = dict(zip(cells["cell"], cells["size"], strict=True))
        blocks = [(r.cell, -(-int(sizes[r.cell]) // GRID_CORPUS), -(-r.asked // GRID_QUERIES)) for r in asked]
        cut = F.broadcast(self.spark.createDataFrame(blocks, "cell int, c_blocks int, q_blocks int"))

        def place(frame: DataFrame, key: str, own: str, other: str) -> DataFrame:
            mine = F.pmod(F.xxhash64(key), F.col(f"{own}_blocks")).cast("int").alias(f"{own}_part")
            every = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1)).alias(f"{other}_part")
            return frame.join(cut, "cell").select(*frame.columns, mine, every)

        left = place(routed, "query_id", "q", "c")
        # a literal list of cells: the folders of the others are not listed for the scan
        right = place(self.rows().where(F.col("cell").isin([r.cell for r in asked])), "vec_id", "c", "q")

        def meet(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
            if q.empty or c.empty:
                return pd.DataFrame(EMPTY)
            c = c.sort_values("residual")
            residual = c["residual"].to_numpy()
            # the ring of each query is a run of the ordered residuals
            start = np.searchsorted(residual, q["d"].to_numpy() - q["within"].to_numpy(), "left")
            end = np.searchsorted(residual, q["d"].to_numpy() + q["within"].to_numpy(), "right")
            some = end > start
            if not some.any():
                return pd.DataFrame(EMPTY)
            q, start, end = q[some], start[some], end[some]
            low, high = start.min(), end.max()
            best = BestHits(q.assign(match=""), k, "l2")
            vectors = np.stack(c["vector"].to_numpy()[low:high])
            best.add(c["vec_id"].to_numpy()[low:high], vectors, np.full(high - low, "", object))
            found = best.rows().assign(n_compared=0)
            ring = pd.DataFrame({"query_id": pd.Series(q["query_id"].to_numpy(), dtype=object), "vec_id": -1, "distance": np.nan, "n_compared": end - start})
            return pd.concat([found, ring], ignore_index=True)

        keys = ["cell", "c_part", "q_part"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, COMPARED)

    def search(self, queries: DataFrame, k: int, probes: int = 2) -> tuple[DataFrame, DataFrame]:
        """The exact k nearest rows of ``queries(query_id, vector)`` as (query_id, place, vec_id, distance), squared
        distance and ties to the smaller vec_id, and (query_id, n_compared)."""
        cells = self._cells()
        centres = np.stack(cells["centre"].to_numpy())
        ids, sizes = cells["cell"].to_numpy(), cells["size"].to_numpy()
        low, high = cells["low"].to_numpy(), cells["high"].to_numpy()

        def route(batches: Iterator[pd.DataFrame], first: bool) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = []
                for query_id, vector, within in zip(batch["query_id"], batch["vector"], batch["within"], strict=True):
                    d = np.sqrt(((centres - np.asarray(vector, float)) ** 2).sum(1))
                    order = np.argsort(d, kind="stable")
                    n = max(probes, int(np.searchsorted(np.cumsum(sizes[order]), k)) + 1)
                    near = order[:n] if first else order[n:]
                    # no row of a cell is nearer than the way from the query to the ring of its residuals
                    gap = np.maximum(0, np.maximum(d - high, low - d))
                    rows += [(query_id, vector, ids[i], d[i], within) for i in near if gap[i] <= within]
                yield pd.DataFrame(rows, columns=["query_id", "vector", "cell", "d", "within"])

        routed = "query_id string, vector array<double>, cell int, d double, within double"
        asked = stage(queries.select(F.col("query_id").cast("string").alias("query_id"), F.col("vector").cast("array<double>").alias("vector")).where("vector IS NOT NULL"))
        first = asked.withColumn("within", F.lit(float("inf"))).mapInPandas(lambda b: route(b, True), routed)
        one = stage(self._compare(stage(first), cells, k))
        order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
        ranked = one.where(F.col("distance").isNotNull()).withColumn("place", F.row_number().over(order))
        reach = ranked.where(F.col("place") == k).select("query_id", (F.sqrt(F.col("distance") + MARGIN) + MARGIN).alias("within"))
        # fewer than k rows in the whole index: every cell was seen in the first pass
        bounded = asked.join(reach, "query_id")
        two = self._compare(stage(bounded.mapInPandas(lambda b: route(b, False), routed)), cells, k)
        both = stage(one.unionByName(two))
        hits = both.where(F.col("distance").isNotNull()).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
        compared = both.groupBy("query_id").agg(F.sum("n_compared").alias("n_compared"))
        return hits.select("query_id", "place", "vec_id", "distance"), compared
