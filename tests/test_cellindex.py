import numpy as np
import pytest
from pyspark.sql import functions as F

from duebook.operators import vectors
from duebook.operators.cellindex import CellIndex
from duebook.session import workspace


def points(spark, n, spread):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8)) * 10
    return spark.createDataFrame([(i, (centres[i % 12] + rng.normal(size=8) * spread).tolist()) for i in range(n)], "vec_id long, vector array<double>")


@pytest.mark.parametrize("spread", [0.3, 30.0])
def test_bounds_keep_the_result_exact(spark, spread):
    corpus = points(spark, 1500, spread)
    repeats = corpus.where("vec_id < 30").withColumn("vec_id", F.col("vec_id") + 5000)
    corpus = corpus.union(repeats).union(spark.createDataFrame([(9999, None)], corpus.schema))
    queries = corpus.where("vec_id % 60 = 0").select(F.col("vec_id").cast("string").alias("query_id"), "vector")
    index = CellIndex(spark, workspace(spark, "test"))
    index.build(corpus, 12)
    found, compared = index.search(queries, 7)
    want = vectors.nearest(queries, corpus, 7)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    share = compared.agg(F.sum("n_compared")).first()[0] / (queries.count() * 1530)
    assert share < 0.25 if spread < 1 else share <= 1


def test_fewer_rows_than_asked_for(spark):
    index = CellIndex(spark, workspace(spark, "test"))
    index.build(points(spark, 5, 1.0), 2)
    queries = points(spark, 2, 1.0).select(F.col("vec_id").cast("string").alias("query_id"), "vector")
    found, _ = index.search(queries, 9, probes=1)
    assert found.groupBy("query_id").count().collect()[0]["count"] == 5
    assert index.search(queries.where("false"), 3)[0].count() == 0
    with pytest.raises(ValueError):
        index.build(points(spark, 5, 1.0).where("false"), 2)


def test_best_hits_break_ties_by_id_over_tiles(spark, monkeypatch):
    monkeypatch.setattr(vectors, "TILE_BYTES", 64)
    import pandas as pd

    queries = pd.DataFrame({"query_id": ["a", "b"], "vector": [[0.0], [1.0]], "match": ["", "x"]})
    best = vectors.BestHits(queries, 3, "l2")
    ids = np.array([9, 3, 7, 1, 5, 2])
    best.add(ids, np.zeros((6, 1)), np.array(["", "", "", "", "", "x"], object))
    assert list(map(tuple, best.rows().to_numpy())) == [("a", 1, 0.0), ("a", 3, 0.0), ("a", 5, 0.0), ("b", 2, 1.0)]
