"""Fits use every labelled row."""

from hashlib import md5

import numpy as np
import pytest
from pyspark.sql import functions as F

from duebook.llm import common, quality


@pytest.mark.parametrize("seed, good, bad", [(1, 300, 500), (2, 4, 0), (3, 0, 4), (4, 1, 1), (5, 90, 7)])
def test_threshold_of_a_table_equals_that_of_a_list(spark, seed, good, bad):
    chance = np.random.default_rng(seed)
    rows = [(round(float(chance.normal(label, 1)), 1), label) for label, n in ((1, good), (0, bad)) for _ in range(n)]
    assert quality.fit_threshold(spark.createDataFrame(rows, "score double, quality int")) == quality.choose_threshold(rows)


def test_quality_counts_every_labelled_document(spark):
    n, words = 30_000, 60
    text = F.when(F.col("id") % 2 == 1, F.repeat(F.lit("good "), words)).otherwise(F.repeat(F.lit("bad "), words))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text"))
    ratios, threshold = quality.fit(docs, docs.select("doc_id", F.expr("cast(doc_id % 2 as int)").alias("quality")))
    trusted = sum(md5(f"part:{i}".encode()).digest()[0] % 2 == 0 for i in range(1, n, 2))
    hashes = quality._Words().of([b"good"] * words)
    found = np.bincount(quality.ngram_buckets(hashes, quality.BUCKETS), minlength=quality.BUCKETS)
    other = np.bincount(quality.ngram_buckets(quality._Words().of([b"bad"] * words), quality.BUCKETS), minlength=quality.BUCKETS)
    raw, mine = (found + other) * n / 2, found * trusted
    background = (raw + 1) / (raw.sum() + quality.BUCKETS)
    wanted = np.log((mine + quality.PRIOR * background) / (mine.sum() + quality.PRIOR) / background)
    assert np.allclose(ratios, wanted, rtol=0, atol=1e-12)


def test_quality_stages_no_texts(spark, monkeypatch):
    n = 4_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 60).alias("text"))
    seen = []
    monkeypatch.setattr(quality, "stage_table", lambda frame, purpose: seen.extend(frame.columns) or common.stage_table(frame, purpose))
    quality.fit(docs, docs.select("doc_id", F.lit(1).alias("quality")))
    assert seen and "text" not in seen


@pytest.mark.parametrize("n_keys", [0, 1, 700, 9_000])
def test_rows_are_divided_by_their_keys(spark, n_keys):
    rows = spark.range(20_000).select(F.when(F.col("id") % 5_000 != 7, F.col("id") % 15_000).alias("key"), F.col("id").alias("n"))
    keys = spark.range(n_keys).select((F.col("id") * 3).alias("key")).union(spark.sql("SELECT cast(null AS bigint) AS key"))
    number = lambda frame: sorted(r.n for r in frame.select("n").collect())
    assert number(common.rows_with(rows, keys)) == number(rows.join(keys, "key", "left_semi"))
    assert number(common.rows_without(rows, keys)) == number(rows.join(keys, "key", "left_anti"))
    certain, unsure, outside = common.sifted(rows, keys)
    assert certain.count() + unsure.count() + outside.count() == 20_000
    assert unsure.count() < 200


def test_a_full_key_filter_still_divides_rightly(spark, monkeypatch):
    monkeypatch.setattr(common, "FILTER_BITS", (1 << 15, 1 << 15))
    rows, keys = spark.range(60_000).toDF("key"), spark.range(0, 60_000, 2).toDF("key")
    assert common.rows_with(rows, keys).agg(F.sum("key"), F.count("*")).first() == keys.agg(F.sum("key"), F.count("*")).first()
    assert common.rows_without(rows, keys).where("key % 2 = 1").count() == common.rows_without(rows, keys).count() == 30_000
