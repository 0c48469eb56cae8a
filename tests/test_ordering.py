import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from duebook.operators.ordering import (
    add_slots,
    cut_points,
    exact_quantiles,
    nth_rows,
    ntiles,
    ntile_from_position,
    number_rows,
    running_totals,
)

SLOW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def test_slots_follow_the_value_and_isolate_heavy_values(spark):
    rows = [(float(v),) for v in range(100)] + [(7.0,)] * 300
    df = spark.createDataFrame(rows, "x double")
    cuts = cut_points(df, {"x": 16})
    slotted = [(r["x"], r["x_slot"]) for r in add_slots(df, cuts).collect()]
    assert [s for _, s in sorted(slotted)] == sorted(s for _, s in slotted)
    heavy = {s for x, s in slotted if x == 7.0}
    assert len(heavy) == 1 and heavy.pop() % 2 == 1
    assert {x for x, s in slotted if s % 2 == 1} >= {7.0}


def test_null_has_no_slot(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    slots = {r["x"]: r["x_slot"] for r in add_slots(df, {"x": [2.0]}).collect()}
    assert slots == {1.0: 0, 3.0: 2, None: None}


@SLOW
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-5, 5), st.integers(0, 9)), min_size=1, max_size=60))
def test_running_totals_equal_the_plain_window(spark, rows):
    data = [(g, v, n, i) for i, (g, v, n) in enumerate(rows)]
    df = spark.createDataFrame(data, "g int, v int, n bigint, id int").withColumn("slot", F.floor(F.col("v") / 3))
    got = running_totals(df.withColumn("upto", F.col("n")), ["g"], ["slot"], ["v", "id"], {"upto": "upto"})
    window = Window.partitionBy("g").orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("upto", F.sum("n").over(window))
    key = ["id", "upto"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))


def test_positions_with_a_third_of_the_rows_tied(spark):
    random.seed(1)
    data = [(i, 0.0 if i % 3 == 0 else random.random()) for i in range(3000)]
    df = spark.createDataFrame(data, "id bigint, x double")
    got = {r["id"]: r["position"] for r in number_rows(df, F.col("x"), F.col("id")).collect()}
    want = {i: p for p, (i, _) in enumerate(sorted(data, key=lambda r: (r[1], r[0])), 1)}
    assert got == want


def test_tied_rows_are_spread_over_many_windows(spark):
    data = [(i, 0.0) for i in range(5000)]
    df = spark.createDataFrame(data, "id bigint, x double")
    cuts = cut_points(df, {"x": 64, "id": 64})
    per_slot = add_slots(df, cuts).groupBy("x_slot", "id_slot").count().agg(F.max("count")).first()[0]
    assert per_slot <= 2 * 5000 / 64


def test_exact_quantiles_equal_percentile(spark):
    random.seed(2)
    data = [(random.choice([0.0, 1.0, random.gauss(0, 1)]), float(random.randint(0, 5))) for _ in range(501)]
    df = spark.createDataFrame(data, "a double, b double")
    levels = {"q1": 0.25, "median": 0.5, "q9": 0.9}
    got = {r["feature"]: [r[q] for q in levels] for r in exact_quantiles(df, ["a", "b"], levels).collect()}
    for name in ("a", "b"):
        want = df.agg(F.percentile(name, F.array(*[F.lit(v) for v in levels.values()]))).first()[0]
        assert all(abs(x - y) < 1e-12 for x, y in zip(got[name], want))


def test_ntile_matches_sql(spark):
    for n in (3, 7, 10, 23):
        df = spark.range(1, n + 1)
        tiles = ntile_from_position(F.col("id"), F.lit(n), 5)
        pairs = df.select(tiles.alias("a"), F.ntile(5).over(Window.orderBy("id")).alias("b")).collect()
        assert all(r["a"] == r["b"] for r in pairs), n


def test_rows_without_a_value_are_numbered_last(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, float("nan")), (4, -1.0), (5, None)], "id bigint, x double")
    got = {r["id"]: r["position"] for r in number_rows(df, F.col("x"), F.col("id")).collect()}
    assert got == {4: 1, 2: 2, 1: 3, 3: 4, 5: 5}


def test_nan_and_null_are_left_out_of_quantiles(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "x double")
    row = exact_quantiles(df, ["x"], {"median": 0.5}).first()
    assert (row["n"], row["median"]) == (2, 2.0)


def test_missing_values_come_after_infinite_ones(spark):
    rows = [(0, None), (1, float("inf")), (2, 1.0), (3, float("-inf")), (4, None), (5, float("nan"))]
    df = spark.createDataFrame(rows, "id bigint, x double")
    got = {r["id"]: r["position"] for r in number_rows(df, F.col("x"), F.col("id")).collect()}
    assert got == {3: 1, 2: 2, 1: 3, 0: 4, 4: 5, 5: 6}


@SLOW
@given(st.lists(st.one_of(st.none(), st.integers(0, 4), st.floats(-3, 3), st.just(float("inf"))), min_size=1, max_size=40))
def test_ntiles_equal_the_plain_window(spark, values):
    data = [(i, None if v is None else float(v), float(i % 3)) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "id bigint, x double, y double")
    got = ntiles(df, {"a": "x", "b": "y"}, "id", 5)
    assert got.columns == ["id", "x", "y", "a", "b"]
    want = df
    for new, old in (("a", "x"), ("b", "y")):
        want = want.withColumn(new, F.ntile(5).over(Window.orderBy(F.col(old).asc_nulls_last(), "id")))
    key = ["id", "a", "b"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))


def test_nth_rows_leave_missing_values_out(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, float("nan")), (4, 1.0), (5, 2.0)], "id bigint, x double")
    assert nth_rows(df, {"x": [1, 3, 4]}, 5) == {"x": {1: (1.0, None), 3: (2.0, None)}}
    assert nth_rows(df, {"x": [2, 3]}, 5, "id") == {"x": {2: (2.0, 1), 3: (2.0, 5)}}
