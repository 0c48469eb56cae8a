"""Stratified folds, weights per fold, and boosting on cells against boosting written out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from duebook.operators import learning, search
from duebook.plans import QUERIES


@pytest.fixture(scope="module")
def cases(spark):
    chance = np.random.default_rng(2)
    x = chance.random((600, 2)).round(3)
    label = (x[:, 0] + 0.3 * chance.random(600) > 0.9).astype(int)
    rows = [(i, float(a) if i % 50 else None, float(b), "s" if i % 3 else None, int(y)) for i, ((a, b), y) in enumerate(zip(x, label, strict=True))]
    return spark.createDataFrame(rows, "id long, a double, b double, sector string, label int")


def test_folds_have_the_same_share_of_each_label(cases):
    placed = search.add_stratified_folds(cases, "id")
    counts = {(r["fold"], r["label"]): r["count"] for r in placed.groupBy("fold", "label").count().collect()}
    for label in (0, 1):
        sizes = [counts[fold, label] for fold in range(5)]
        assert max(sizes) - min(sizes) <= 1
    for r in search.fold_weights(placed).collect():
        others = [sum(n for (fold, label), n in counts.items() if fold != r["fold"] and label == y) for y in (0, 1)]
        assert (r["train_neg"], r["train_pos"]) == tuple(others) and r["pos_weight"] == pytest.approx(others[0] / others[1], abs=1e-6)


def test_cells_count_every_row_and_stay_bounded(cases):
    placed = search.add_stratified_folds(cases, "id")
    counted = search.cells(placed, ["a", "b"], ["sector"])
    sums = counted.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.max("b0").alias("widest")).first()
    assert sums["pos"] + sums["neg"] == 600 and counted.where("b0 = 0").count() > 0
    for numeric, categories in ((1, 0), (3, 2), (4, 1)):
        bins = search.bins_for(numeric, categories, 5)
        assert 2 <= bins <= search.MOST_BINS and bins**numeric * search.MOST_CATEGORIES**categories * 5 <= search.MOST_CELLS
    with pytest.raises(ValueError):
        search.cells(placed, ["n_overdue"], [])


def test_a_single_stump_is_the_best_of_all_splits():
    chance = np.random.default_rng(4)
    codes, pos, neg = chance.integers(0, 5, (40, 3)), chance.integers(0, 4, 40), chance.integers(0, 4, 40)
    weight, setting = 1.7, search.Setting(1, 0.5, 1, 0, 1.0, 1.0)
    got = search.margins(codes, pos, neg, weight, setting, 1)
    grad, curve = -0.5 * weight * pos + 0.5 * neg, 0.25 * (weight * pos + neg)
    best = None
    for i in range(3):
        for cut in range(4):
            left = codes[:, i] <= cut
            parts = [(grad[s].sum(), curve[s].sum() + 1) for s in (left, ~left)]
            gain = sum(g * g / h for g, h in parts)
            if best is None or gain > best[0] + 1e-9:
                best = gain, np.where(left, *[-0.5 * g / h for g, h in parts])
    assert got == pytest.approx(best[1])


def test_area_counts_pairs():
    score, pos, neg = np.array([0.1, 0.4, 0.4, 0.9]), np.array([0, 2, 1, 3]), np.array([4, 1, 0, 1])
    pairs = [(0.5 * (a == b) + (a > b)) * p * n for a, p in zip(score, pos, strict=True) for b, n in zip(score, neg, strict=True)]
    assert search.area(score, pos, neg) == pytest.approx(sum(pairs) / (6 * 6)) and search.area(score, pos, 0 * neg) == 0.0


def test_search_finds_the_signal_and_repeats(cases):
    table = [search.search(cases, ["a", "b"], ["sector"], "id", trials=3, folds=4).collect() for _ in range(2)]
    assert table[0] == table[1] and len(table[0]) == 3 and all(r["mean_auc"] > 0.9 and r["n_folds"] == 4 and r["n_rows"] == 600 for r in table[0])


def test_the_query_searches_thirty_settings_in_five_folds(spark, folder):
    rows = QUERIES["cv_results"](spark, folder).collect()
    assert len(rows) == 30 and {r["n_folds"] for r in rows} == {5} and len({r["n_rows"] for r in rows}) == 1
    assert [r["mean_auc"] for r in rows] == sorted((r["mean_auc"] for r in rows), reverse=True)
    for r in rows:
        assert 3 <= r["depth"] <= 10 and 50 <= r["rounds"] <= 300 and 0.01 <= r["step"] <= 0.3 and 1 <= r["child_weight"] <= 10


def test_row_search_of_the_library_still_runs(cases):
    rows = cases.fillna({"a": 0.0, "sector": "t"}).withColumn("size_band", F.lit("m"))
    assert learning.tune(rows, ["a", "b"], "id", trials=1, folds=2).count() == 1
