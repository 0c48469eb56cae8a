"""Queries that shuffled more than their input: the same rows with less."""

import math

import numpy as np
from pyspark.sql import functions as F

from duebook.operators import documents, vectors


def test_top_terms_by_either_join_equal_counting(spark, monkeypatch):
    chance = np.random.default_rng(4)
    texts = [(i % 50, " ".join(f"t{int(w)}" for w in chance.zipf(1.4, 60) % 200)) for i in range(60)] + [(None, "t1 T1 odd"), (90, None)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    counts: dict = {}
    for key, text in texts:
        for word in (text or "").lower().split():
            counts[key, word] = counts.get((key, word), 0) + 1
    df: dict = {}
    for _, word in counts:
        df[word] = df.get(word, 0) + 1
    wanted = set()
    for key in {k for k, _ in counts}:
        own = sorted((-round(n * math.log(len(texts) / df[w]), 6), w, n) for (k, w), n in counts.items() if k == key)[:5]
        wanted |= {(key, place, w, n) for place, (_, w, n) in enumerate(own, 1)}
    for share in (1, 40, 100_000):
        monkeypatch.setattr(documents, "COMMON_SHARE", share)
        assert {(r.doc_id, r.place, r.term, r.tf) for r in documents.top_terms(frame).collect()} == wanted


def test_hashing_search_equals_sparks_join_and_shuffles_no_candidates(spark):
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    chance = np.random.default_rng(6)
    rows = [(i, [float(x) for x in chance.normal(0, 0.4, 8)]) for i in range(400)]
    rows += [(400 + i, rows[i][1]) for i in range(20)]
    corpus = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    asked = spark.createDataFrame([(str(i), rows[i * 7][1]) for i in range(9)], "query_id string, vector array<double>")
    exact = vectors.nearest(asked, corpus, 5)
    dense, wanted = corpus.select("vec_id", array_to_vector("vector").alias("v")), asked.select("query_id", array_to_vector("vector").alias("v"))
    model = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=1.0, numHashTables=6, seed=42).fit(dense)
    pairs: dict = {}
    for r in model.approxSimilarityJoin(dense, wanted, 0.9, distCol="d").collect():
        pairs.setdefault(r.datasetB.query_id, []).append((round(r.d**2, 6), r.datasetA.vec_id))
    near = {(q, i) for q, found in pairs.items() for _, i in sorted(found)[:5]}
    want: dict = {}
    for r in exact.collect():
        want[r.query_id] = want.get(r.query_id, 0) + ((r.query_id, r.vec_id) in near)
    found = vectors.lsh_recall(corpus, asked, exact, 5, 0.9)
    assert {r.query_id: r.n_found for r in found.collect()} == want and any(0 < n for n in want.values())
    twice = vectors.lsh_recall(corpus.union(corpus), asked.union(asked), exact, 5, 0.9)
    assert {r.query_id: r.n_found for r in twice.collect()} == want
    assert "Generate explode" not in found._jdf.queryExecution().executedPlan().toString()
