"""Connected components by alternating large-star and small-star rounds.

Each round hangs every node on a smaller neighbour; a star keeps one edge per node, so the edge table never grows
beyond its first size, and the number of rounds follows the logarithm of the longest chain. Rounds are written to the
shared folder. Only counts reach the driver.

Defined cases: self-loops and edges with a null end carry nothing and are dropped; repeated edges count once; without
edges the result is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage_table


def _hang(edges: DataFrame, ends: DataFrame, minimum: DataFrame) -> DataFrame:
    joined = ends.join(minimum, "u")
    return joined.select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest of its neighbourhood."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    minimum = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return _hang(edges, both.where("v > u"), minimum)


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node itself, moves to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    minimum = down.groupBy("u").agg(F.min("v").alias("low"))
    ends = down.union(minimum.select("u", F.col("u").alias("v")))
    return _hang(edges, ends, minimum)


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) to (node, root): root is the smallest node reachable; only nodes with an edge appear."""
    current = stage_table(edges.select("u", "v").where("u <> v").distinct(), "edges")
    seen = None
    while True:
        current = stage_table(_small_star(_large_star(current)), "stars")
        state = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
