"""Trends that change slope, against least squares over every set of candidates."""

import datetime as dt
from math import floor, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from duebook.operators import cashflow, changepoints

MONDAY = dt.date(2023, 1, 2)


def points_of(spark, series):
    rows = [(key, MONDAY + dt.timedelta(days=7 * i), float(v)) for key, values in series.items() for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "seg string, week date, net double").withColumn("net", F.col("net").cast("decimal(28,4)"))
    return cashflow.clean_series(frame.withColumn("special", cashflow.special_week(F.col("week"))), ["seg"])


def best_by_least_squares(values, special):
    u, y = np.arange(len(values), dtype=float), np.array(values, float)
    span, tries = len(values) - 1, []
    for i, j in changepoints.candidate_sets():
        knots = [floor(span * 8 * c / (10 * 11)) for c in (i, j) if c]
        if knots and len(values) <= 4 + 2 * len(knots):
            continue
        x = np.column_stack([np.ones_like(u), u, special, *[np.maximum(u - k, 0) for k in knots]])
        error = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
        sse = float(error @ error)
        tries.append((len(u) * log(max(sse / len(u), 1e-9)) + (3 + 2 * len(knots)) * log(len(u)), len(knots), knots, sse))
    return min(tries)


def test_the_chosen_fit_is_the_best_of_all_sets(spark):
    chance, weeks = np.random.default_rng(7), np.arange(90)
    bends = {"none": 0 * weeks, "one": np.maximum(weeks - 38, 0) * 9.0, "two": np.maximum(weeks - 19, 0) * 8.0 - np.maximum(weeks - 58, 0) * 15.0}
    series = {key: np.round(50 + 2 * weeks + bend + chance.normal(size=90) * 5, 4) for key, bend in bends.items()}
    series["short"] = np.round(chance.normal(size=5), 4)
    points = points_of(spark, series)
    for row in changepoints.fit_changes(points, ["seg"]).collect():
        special = [r.special for r in points.where(F.col("seg") == row["seg"]).orderBy("t").collect()]
        _, count, knots, sse = best_by_least_squares(series[row["seg"]], np.array(special, float))
        assert row["knots"] == count and [row["k1"], row["k2"]][:count] == knots, row["seg"]
        assert row["sse"] == pytest.approx(sse, rel=1e-6, abs=1e-6)
        assert count == {"none": 0, "one": 1, "two": 2, "short": 0}[row["seg"]]


def test_a_planted_break_lowers_the_holdout_error(spark):
    chance, weeks = np.random.default_rng(3), np.arange(120)
    broken = 1000 + 5 * weeks - np.maximum(weeks - 60, 0) * 25 + chance.normal(size=120) * 4
    row = changepoints.backtest(points_of(spark, {"a": np.round(broken, 4)}), ["seg"]).first()
    assert row["n_holdout"] == 13 and row["mae_bent"] < 0.1 * row["mae_straight"]


def test_a_straight_series_forecasts_as_the_straight_trend(spark):
    weeks = np.arange(70)
    points = points_of(spark, {"a": 300 + 4.0 * weeks + np.where(weeks % 2, 1, -1)})
    bent = changepoints.forecast(points, ["seg"]).orderBy("week").collect()
    straight = cashflow.forecast(points, ["seg"]).orderBy("week").collect()
    assert [r["week"] for r in bent] == [r["week"] for r in straight] and len(bent) == 13
    for a, b in zip(bent, straight, strict=True):
        assert a["forecast"] == pytest.approx(b["forecast"], abs=0.02) and a["upper"] == pytest.approx(b["upper"], abs=0.02)


def test_one_point_and_a_constant_series(spark):
    points = points_of(spark, {"one": [5.0], "flat": [7.0] * 30})
    fits = {r["seg"]: r for r in changepoints.fit_changes(points, ["seg"]).collect()}
    assert (fits["one"]["level"], fits["one"]["b_u"]) == (5.0, 0.0) and fits["flat"]["knots"] == 0
    assert {round(r["forecast"], 2) for r in changepoints.forecast(points, ["seg"]).collect()} == {5.0, 7.0}
