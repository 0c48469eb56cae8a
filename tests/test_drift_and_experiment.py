import math
import random

import pytest
from pyspark.sql import functions as F

from duebook.functions.probability import chi2_p, kolmogorov_p, normal_cdf
from duebook.operators import drift, experiment


def two_samples(spark, a, b):
    rows = [(False, float(v)) for v in a] + [(True, float(v)) for v in b]
    return spark.createDataFrame(rows, "is_current boolean, x double")


def ks_of(spark, a, b):
    return drift.feature_drift(two_samples(spark, a, b), ["x"]).first()


def test_identical_and_disjoint_samples(spark):
    same = ks_of(spark, range(50), range(50))
    assert (same["ks"], same["p_value"], same["has_drift"]) == (0.0, 1.0, 0)
    apart = ks_of(spark, range(50), range(100, 150))
    assert apart["ks"] == 1.0 and apart["has_drift"] == 1


def test_ks_is_symmetric_and_right(spark):
    random.seed(5)
    a = [random.choice([0.0, random.gauss(0, 1)]) for _ in range(200)]
    b = [random.choice([0.0, random.gauss(0.3, 1)]) for _ in range(150)]
    want = max(abs(sum(x <= t for x in a) / len(a) - sum(x <= t for x in b) / len(b)) for t in a + b)
    there, back = ks_of(spark, a, b), ks_of(spark, b, a)
    assert there["ks"] == pytest.approx(want, abs=1e-6) == back["ks"]
    assert 0 <= there["ks"] <= 1


def test_baseline_mean_zero_gives_null_shift(spark):
    assert ks_of(spark, [-1, 1], [2, 3])["mean_shift_pct"] is None


def test_nulls_are_dropped(spark):
    df = spark.createDataFrame([(False, 1.0), (False, None), (True, 1.0)], "is_current boolean, x double")
    row = drift.feature_drift(df, ["x"]).first()
    assert (row["n_ref"], row["n_cur"], row["ks"]) == (1, 1, 0.0)


def test_probability_functions(spark):
    df = spark.range(1)
    z = [-3.0, -1.96, 0.0, 0.5, 2.5]
    got = df.select(*[normal_cdf(F.lit(v)).alias(str(i)) for i, v in enumerate(z)]).first()
    for value, p in zip(z, got):
        assert p == pytest.approx(0.5 * (1 + math.erf(value / math.sqrt(2))), abs=2e-7)
    tails = df.select(*[chi2_p(F.lit(x), F.lit(k)).alias(f"c{i}") for i, (x, k) in enumerate(CHI2)]).first()
    for (x, k), p in zip(CHI2, tails):
        assert p == pytest.approx(CHI2[x, k], abs=5e-5)
    lam = df.select(kolmogorov_p(F.lit(0.12), F.lit(200).cast("bigint"), F.lit(200).cast("bigint"))).first()[0]
    assert lam == pytest.approx(0.112249667, abs=1e-6)


# published critical values, rounded to three decimals
CHI2 = {(3.841, 1): 0.05, (5.991, 2): 0.05, (7.815, 3): 0.05, (9.488, 4): 0.05, (11.070, 5): 0.05, (6.635, 1): 0.01}


def test_class_drift_with_a_new_class(spark):
    rows = [(False, "a")] * 10 + [(True, "a")] * 9 + [(True, "b")]
    df = spark.createDataFrame(rows, "c boolean, y string")
    row = drift.class_drift(df, "y", F.col("c"), "y").first()
    assert row["p_value"] == 0.0 and row["has_drift"] == 1
    steady = drift.class_drift(spark.createDataFrame([(c, y) for c in (False, True) for y in "aab"], "c boolean, y string"), "y", F.col("c"), "y").first()
    assert (steady["statistic"], steady["p_value"]) == (0.0, 1.0)


def test_dataset_drift_needs_more_than_the_share(spark):
    table = spark.createDataFrame([("a", 1, 0.5), ("b", 0, 0.1), ("c", 0, 0.2)], "feature string, has_drift int, ks double")
    row = drift.drift_summary(table).first()
    assert (row["n_drifted"], row["dataset_drift"], row["worst_feature"]) == (1, 1, "a")


def ztest(spark, control, treatment):
    rows = [(False, y) for y in control] + [(True, y) for y in treatment]
    df = spark.createDataFrame(rows, "t boolean, y boolean")
    return experiment.two_proportion_test(df, F.col("t"), F.col("y")).first()


def test_two_proportions(spark):
    row = ztest(spark, [True] * 50 + [False] * 50, [True] * 30 + [False] * 70)
    pooled = 0.4
    z = 0.2 / math.sqrt(pooled * (1 - pooled) * (2 / 100))
    assert row["z_stat"] == pytest.approx(z, abs=1e-6)
    assert row["p_value"] == pytest.approx(1 - 0.5 * (1 + math.erf(z / math.sqrt(2))), abs=1e-6)
    assert (row["relative_lift"], row["significant"]) == (0.4, 1)


def test_two_proportions_without_outcomes(spark):
    row = ztest(spark, [False] * 5, [False] * 5)
    assert (row["z_stat"], row["relative_lift"], row["significant"]) == (0.0, 0.0, 0)


def test_arms_depend_on_the_key_alone(spark):
    df = spark.range(200).withColumnRenamed("id", "k")
    one = {r["k"]: (r["arm"], r["route"]) for r in experiment.assign_arms(df.repartition(7), "k").collect()}
    two = {r["k"]: (r["arm"], r["route"]) for r in experiment.assign_arms(df.coalesce(1), "k").collect()}
    assert one == two
    assert 60 < sum(a == "treatment" for a, _ in one.values()) < 140
