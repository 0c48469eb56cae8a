import random

import pytest
from pyspark.sql import functions as F

from duebook.operators import evaluate, scorecard

SCHEMA = "customer_id bigint, label int, score double"


def frame(spark, rows):
    df = spark.createDataFrame([(i, y, s) for i, (y, s) in enumerate(rows)], SCHEMA)
    return df.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def rows():
    random.seed(3)
    return [(random.randint(0, 1), round(random.choice([0.3, 0.5, random.random()]), 6)) for _ in range(400)]


def test_auc_with_ties_and_its_mirror(spark, rows):
    got = evaluate.auc(frame(spark, rows)).first()["auc"]
    assert got == pytest.approx(brute_auc(rows), abs=1e-6)
    mirrored = evaluate.auc(frame(spark, [(y, round(1 - s, 6)) for y, s in rows])).first()["auc"]
    assert mirrored == pytest.approx(1 - got, abs=2e-6)


def test_one_class_gives_zero(spark):
    assert evaluate.auc(frame(spark, [(1, 0.2), (1, 0.9)])).first()["auc"] == 0.0


def test_separable_scores(spark):
    df = frame(spark, [(0, 0.1)] * 5 + [(1, 0.9)] * 5)
    metrics = evaluate.classification_metrics(df).first()
    assert (metrics["accuracy"], metrics["precision"], metrics["recall"], metrics["f1"]) == (1.0, 1.0, 1.0, 1.0)
    assert evaluate.auc(df).first()["auc"] == 1.0
    assert evaluate.ks(df).first()["ks"] == 1.0
    assert evaluate.average_precision(df).first()["average_precision"] == 1.0


def test_no_positive_prediction_gives_zero_metrics(spark):
    metrics = evaluate.classification_metrics(frame(spark, [(1, 0.1), (0, 0.2)])).first()
    assert (metrics["precision"], metrics["recall"], metrics["f1"]) == (0.0, 0.0, 0.0)


def test_average_precision_and_ks_by_brute_force(spark, rows):
    ap, seen_pos, seen = 0.0, 0, 0
    total = sum(y for y, _ in rows)
    for s in sorted({s for _, s in rows}, reverse=True):
        here = [y for y, t in rows if t == s]
        seen_pos, seen = seen_pos + sum(here), seen + len(here)
        ap += sum(here) / total * seen_pos / seen
    df = frame(spark, rows)
    assert evaluate.average_precision(df).first()["average_precision"] == pytest.approx(ap, abs=1e-6)
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    gap = max(abs(sum(p <= s for p in pos) / len(pos) - sum(n <= s for n in neg) / len(neg)) for _, s in rows)
    assert evaluate.ks(df).first()["ks"] == pytest.approx(gap, abs=1e-6)


def test_threshold_sweep_by_brute_force(spark, rows):
    got = {round(r["threshold"], 2): (r["f1"], r["is_best"]) for r in evaluate.threshold_sweep(frame(spark, rows)).collect()}
    assert len(got) == 40 and sum(b for _, b in got.values()) == 1
    for t in (0.3, 0.5, 0.57, 0.69):
        tp = sum(y for y, s in rows if s >= t)
        fp = sum(1 - y for y, s in rows if s >= t)
        fn = sum(y for y, s in rows if s < t)
        assert got[t][0] == pytest.approx(2 * tp / (2 * tp + fp + fn), abs=1e-6)


def test_deciles_keep_equal_scores_together(spark):
    table = evaluate.decile_table(frame(spark, [(i % 2, 0.5) for i in range(50)])).collect()
    assert [(r["decile"], r["n"]) for r in table] == [(1, 50)]
    spread = evaluate.decile_table(frame(spark, [(int(i > 50), i / 100) for i in range(100)]))
    assert [r["n"] for r in spread.orderBy("decile").collect()] == [10] * 10
    assert evaluate.decile_inversions(spread).first()["inversions"] == 0


def test_split_is_disjoint_complete_and_stratified(spark, rows):
    df = frame(spark, rows)
    split = evaluate.stratified_split(df)
    assert split.count() == split.select("customer_id").distinct().count() == len(rows)
    share = {(r["label"], r["split"]): r["n"] for r in split.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
    for y in (0, 1):
        n = share[y, "train"] + share[y, "test"]
        assert share[y, "train"] == n * 8 // 10


def test_permutation_importance_finds_the_used_feature(spark):
    random.seed(4)
    data = [(i, random.randint(0, 1)) for i in range(300)]
    df = spark.createDataFrame([(i, y, y * 0.5 + 0.2, random.random()) for i, y in data], "customer_id bigint, label int, a double, b double")
    table = evaluate.permutation_importance(df, ["a", "b"], lambda a, b: F.round(a, 6))
    drops = {r["feature"]: r["auc_drop"] for r in table.collect()}
    assert drops["b"] == 0.0 and drops["a"] > 0.3


def test_leakage_columns_are_rejected():
    with pytest.raises(ValueError):
        scorecard.assert_no_leakage(["n_known", "overdue_rate"])
    scorecard.assert_no_leakage(scorecard.FEATURES)


def test_label_never_sees_the_feature_period(spark):
    import datetime as dt

    as_of = dt.date(2024, 1, 1)
    rows = [(1, 10.0, dt.date(2022, 1, 1), "OVERDUE"), (1, 10.0, dt.date(2023, 6, 1), "PAID"), (2, 5.0, dt.date(2022, 1, 1), "PAID")]
    df = spark.createDataFrame(rows, "customer_id int, amount double, issue_date date, status string")
    got = scorecard.point_in_time(df.withColumn("amount", F.col("amount").cast("decimal(18,2)")), as_of).collect()
    assert [(r["customer_id"], r["overdue_share"], r["label"]) for r in got] == [(1, 1.0, 0)]
