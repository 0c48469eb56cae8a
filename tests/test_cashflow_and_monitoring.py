import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from duebook.operators import cashflow, monitoring

MONDAY = dt.date(2024, 1, 1)


def series(spark, values, key="a"):
    rows = [(key, MONDAY + dt.timedelta(days=7 * i), float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "seg string, week date, net double")
    return df.withColumn("net", F.col("net").cast("decimal(28,4)")).withColumn("special", cashflow.special_week(F.col("week")))


def test_special_weeks(spark):
    days = [dt.date(2024, 11, 19), dt.date(2024, 11, 20), dt.date(2024, 12, 14), dt.date(2024, 12, 15), dt.date(2024, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r[0] for r in df.select(cashflow.special_week(F.col("d"))).collect()] == [0, 1, 0, 1, 0]


def test_fit_recovers_trend_and_event(spark):
    points = cashflow.clean_series(series(spark, range(60)), ["seg"])
    shifted = points.withColumn("y", (F.col("t") * 3 + F.col("special") * 50 + 7).cast("decimal(28,4)"))
    fit = cashflow.fit_trend(shifted, ["seg"]).first()
    assert fit["slope"] == pytest.approx(3, abs=1e-6) and fit["effect"] == pytest.approx(50, abs=1e-5)
    ahead = cashflow.forecast(shifted, ["seg"]).orderBy("days_ahead").collect()
    assert len(ahead) == 13 and ahead[0]["week"] == MONDAY + dt.timedelta(days=7 * 60)
    assert ahead[-1]["horizon"] == "61-90 days" and ahead[0]["lower"] <= ahead[0]["forecast"] <= ahead[0]["upper"]


def test_fit_matches_least_squares(spark):
    rng = np.random.default_rng(1)
    values = np.round(rng.normal(size=80) * 100, 4)
    points = cashflow.clean_series(series(spark, values), ["seg"])
    rows = points.orderBy("t").collect()
    x = np.array([[1, r["t"], r["special"]] for r in rows], dtype=float)
    y = np.array([float(r["y"]) for r in rows])
    level, slope, effect = np.linalg.lstsq(x, y, rcond=None)[0]
    fit = cashflow.fit_trend(points, ["seg"]).first()
    assert fit["slope"] == pytest.approx(slope, rel=1e-5) and fit["effect"] == pytest.approx(effect, rel=1e-5)


def test_outlier_is_removed(spark):
    flagged = cashflow.flag_outliers(series(spark, [1, 2, 3, 4, 5, 6, 7, 1000]))
    assert [float(r["net"]) for r in flagged.filter("is_outlier = 1").collect()] == [1000.0]


@pytest.mark.parametrize("weeks, expected", [(9, (5, 4, False)), (10, (6, 4, False)), (13, (9, 4, False)), (14, (10, 4, True)), (100, (87, 13, True))])
def test_backtest_split(spark, weeks, expected):
    row = cashflow.backtest(cashflow.clean_series(series(spark, range(weeks)), ["seg"]), ["seg"]).first()
    assert (row["n_train"], row["n_holdout"], row["mae"] is not None) == expected


def log(spark, rows):
    return spark.createDataFrame(rows, "version string, period int, auc double, f1 double, precision double, recall double, n_predictions bigint, drift_share double").withColumn("period_end", F.make_date("period", F.lit(12), F.lit(31)))


def test_alert_rules(spark):
    rows = [
        ("v1", 2020, 0.8, 0.7, 0.7, 0.7, 100, 0.0),
        ("v1", 2021, 0.74, 0.6, 0.7, 0.7, 40, 0.4),
        ("v1", 2022, 0.9, 0.9, 0.7, 0.7, 3000, 0.6),
    ]
    fired = monitoring.alerts(log(spark, rows))
    got = sorted((r["period_end"].year, r["metric_name"], r["severity"], r["status"]) for r in fired.collect())
    assert got == [
        (2021, "auc", "high", "resolved"),
        (2021, "drift_share", "high", "resolved"),
        (2021, "f1", "high", "resolved"),
        (2021, "n_predictions", "medium", "resolved"),
        (2022, "drift_share", "critical", "open"),
        (2022, "n_predictions", "medium", "open"),
    ]
    assert [r["severity"] for r in monitoring.open_alerts(fired).collect()] == ["critical", "medium"]


def test_rollback_signals(spark):
    rows = [("v1", 1, 0.8, 0.7, 0.7, 0.7, 100, 0.0), ("v1", 2, 0.65, 0.7, 0.7, 0.7, 49, 0.0), ("v1", 3, 0.8, 0.7, 0.7, 0.7, 48, 0.51)]
    got = [tuple(r)[2:] for r in monitoring.rollback_signals(log(spark, rows)).orderBy("period").collect()]
    assert got == [(0, 0, 0, 0), (1, 1, 0, 1), (0, 0, 1, 1)]


def test_promotion_and_champion(spark):
    rows = [
        ("v1", 1, 0.70, 0.60, 0.7, 0.7, 100, 0.0),
        ("v2", 1, 0.75, 0.50, 0.7, 0.7, 100, 0.0),
        ("v3", 1, 0.76, 0.51, 0.7, 0.7, 100, 0.0),
    ]
    table = log(spark, rows)
    decisions = {r["version"]: (r["approved"], r["no_metric_worse"]) for r in monitoring.promotion_decisions(table).collect()}
    assert decisions == {"v2": (1, 0), "v3": (0, 1)}
    versions = monitoring.version_log(table)
    assert [r["status"] for r in versions.orderBy("version_number").collect()] == ["production", "production", "staging"]
    alias = {r["alias"]: r["variant"] for r in monitoring.current_champion(versions).collect()}
    assert alias == {"champion": "v2", "challenger": "v1"}
    assert monitoring.next_version_number(versions, monitoring.MODEL).first()[0] == 4
    assert monitoring.next_version_number(versions, "other").first()[0] == 1
