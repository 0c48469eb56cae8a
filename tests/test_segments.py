import random

import pytest

from duebook.operators import learning, segments

FEATURES = ("billed_90d", "n_invoices", "pay_rate", "overdue_rate", "recency_days", "recency_score")
SCHEMA = "customer_id int, " + ", ".join(f"{f} double" for f in FEATURES)


def test_far_groups_have_a_high_silhouette(spark):
    rows = [(i, 7300.0 + 11 * i, 31.0, 0.88, 0.05, 12.0 + i % 3, 5.0) for i in range(10)]
    rows += [(i, 240.0 + 3 * i, 2.0, 0.21, 0.77, 410.0 + i % 4, 1.0) for i in range(10, 24)]
    _, clustered = segments.fit(segments.scale(spark.createDataFrame(rows, SCHEMA), FEATURES), k=2)
    assert segments.silhouette(clustered) > 0.7
    profiles = {r["customer_id"]: r["profile"] for r in segments.name_clusters(clustered).collect()}
    assert profiles[0] == "Medium risk" and profiles[15] == "High risk"


def test_alike_rows_have_a_low_silhouette(spark):
    rng = random.Random(19)
    rows = [
        (i, rng.gauss(2100, 30), rng.gauss(17, 1.5), rng.gauss(0.4, 0.03), rng.gauss(0.3, 0.03), rng.gauss(66, 4), 4.0)
        for i in range(36)
    ]
    _, clustered = segments.fit(segments.scale(spark.createDataFrame(rows, SCHEMA), FEATURES), k=2)
    assert segments.silhouette(clustered) < 0.5


def test_clusters_beyond_the_list_have_names_of_their_own(spark):
    rows = [(i, i, i / 10) for i in range(6)]
    named = segments.name_clusters(spark.createDataFrame(rows, "customer_id int, cluster int, overdue_rate double"))
    want = ["Premium 3", "Premium 2", "Premium", "Low risk", "Medium risk", "High risk"]
    assert [r["profile"] for r in named.orderBy("cluster").collect()] == want


def test_nulls_become_zero_and_ids_stay_in_range(spark):
    rows = [(0, *[None] * 6), (1, 1.0, 2.0, 3.0, 4.0, 5.0, 1.0)] + [(i, *[float(i * j) for j in range(1, 7)]) for i in range(2, 20)]
    scaled = segments.scale(spark.createDataFrame(rows, SCHEMA), FEATURES)
    assert list(scaled.filter("customer_id = 0").first()["raw"].toArray()) == [0.0] * 6
    _, clustered = segments.fit(scaled, k=4)
    assert {r["cluster"] for r in clustered.collect()} <= set(range(4)) and clustered.count() == 20


def test_recency_of_customers_without_invoices(spark):
    df = spark.createDataFrame([(1, 5), (2, 90), (3, None)], "customer_id int, recency_days int")
    assert {r[0]: r[1] for r in segments.impute_recency(df).collect()} == {1: 5, 2: 90, 3: 90}


@pytest.fixture(scope="module")
def cases(spark):
    rng = random.Random(1)
    rows = []
    for i in range(200):
        y = i % 2
        rows.append((i, y, y + rng.uniform(-0.2, 0.2), rng.random(), "A" if i % 3 else "B", "SMALL"))
    return spark.createDataFrame(rows, "customer_id int, label int, a double, b double, sector string, size_band string")


def test_classifier_separates_and_repeats(spark, cases):
    model = learning.fit_default_model(cases, ["a", "b"])
    scored = learning.score_default(model, cases)
    assert scored.filter("label = predicted").count() == 200
    again = learning.score_default(learning.fit_default_model(cases, ["a", "b"]), cases)
    pick = ["customer_id", "score"]
    assert sorted(map(tuple, scored.select(pick).collect())) == sorted(map(tuple, again.select(pick).collect()))
    assert learning.importances(model, cases).first()["feature"] == "a"


def test_trainers_reject_leaking_columns(cases):
    with pytest.raises(ValueError):
        learning.fit_default_model(cases, ["a", "overdue_rate"])
    with pytest.raises(ValueError):
        learning.fit_value_model(cases, ["billed_90d"], "actual_value")
