"""Run logs, versions with saved pipelines, the champion's predictions and the figures made from them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from duebook.operators import champions, evaluate, scorecard
from duebook.sources import schemas
from duebook.sources.runs import RunLog

ONE, TWO = dt.date(2001, 12, 31), dt.date(2002, 12, 31)


def test_a_repeated_run_replaces_its_own_rows_only(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"), schemas.table(n=schemas.INT, note=schemas.TEXT))
    assert log.read().count() == 0 and log.read().columns == ["n", "note", "run_id"]
    frame = lambda *rows: spark.createDataFrame(list(rows), "n int")
    log.write("2001-01-01", frame((1,), (2,)))
    log.write("2001-01-02", frame((3,)))
    log.write("2001-01-02", frame((4,), (4,)))
    assert sorted((r.run_id, r.n, r.note) for r in log.read().collect()) == [("2001-01-01", 1, None), ("2001-01-01", 2, None), ("2001-01-02", 4, None), ("2001-01-02", 4, None)]
    assert log.read(before="2001-01-02").count() == 2 and log.read(upto="2001-01-01").count() == 2
    log.write("2001-01-02", frame((4,)).limit(0))
    assert log.read().count() == 2
    with pytest.raises(ValueError):
        log.write("../elsewhere", frame((1,)))
    with pytest.raises(ValueError):
        log.write("2001-01-03", frame((1,)).withColumn("stray", F.lit(1)))


def metric_rows(spark, *rows):
    frame = spark.createDataFrame(list(rows), "version string, period int, auc double, f1 double")
    last = F.make_date("period", F.lit(12), F.lit(31))
    return frame.selectExpr("*", "0.5D AS precision", "0.5D AS recall", "100L AS n_predictions", "make_date(period, 1, 1) AS period_start").withColumn("period_end", last)


@pytest.fixture
def two_runs(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "versions"), schemas.VERSION_ROWS)
    champions.append_versions(log, metric_rows(spark, ("v1", 2001, 0.7, 0.6), ("v2", 2001, 0.71, 0.6)), ONE, str(tmp_path))
    champions.append_versions(log, metric_rows(spark, ("v1", 2002, 0.7, 0.6), ("v3", 2002, 0.8, 0.6)), TWO, str(tmp_path))
    return log, str(tmp_path)


def test_numbers_go_on_and_a_promotion_retires_the_champion(two_runs, spark):
    log, models = two_runs
    before = sorted(map(tuple, log.read().collect()))
    champions.append_versions(log, metric_rows(spark, ("v1", 2002, 0.7, 0.6), ("v3", 2002, 0.8, 0.6)), TWO, models)
    assert sorted(map(tuple, log.read().collect())) == before
    states = {r.version_number: (r.variant, r.status, r.retired_at) for r in champions.version_states(log.read()).collect()}
    assert states == {1: ("v1", "retired", dt.datetime(2002, 12, 31)), 2: ("v2", "staging", None), 3: ("v1", "staging", None), 4: ("v3", "production", None)}
    assert champions.champion(log.read(upto="2001-12-31"))["variant"] == "v1" and champions.champion(log.read())["variant"] == "v3"
    assert champions.champion(log.read(), "another model") is None
    with pytest.raises(LookupError):
        champions.load_champion(log, models, "1999-01-01")


def test_predictions_come_from_the_saved_champion_of_the_day(two_runs, spark, tmp_path):
    versions, models = two_runs
    facts = spark.createDataFrame([(1, "Regular", 0.0, 1000.0, 3, 0), (2, "Premium", 1.0, 250000.0, 40, 1), (3, None, 0.5, 0.0, 1, 1)], "customer_id long, category string, overdue_share double, mean_amount double, n_known long, label int")
    log = RunLog(spark, str(tmp_path / "predictions"), schemas.PREDICTION_ROWS)
    days = {dt.date(2002, 6, 1): "v1", dt.date(2003, 6, 1): "v3"}
    for day in [*days, *days]:
        champions.append_predictions(log, versions, models, facts, day)
    for day, variant in days.items():
        want = {r.customer_id: (r.score, r.predicted) for r in scorecard.add_score(facts, variant).collect()}
        rows = log.read().where(F.col("run_id") == day.isoformat()).collect()
        assert {r.customer_id: (r.probability, r.predicted) for r in rows} == want and len(rows) == 3
    metrics = RunLog(spark, str(tmp_path / "metrics"), schemas.METRIC_ROWS)
    for day in [*days, *days]:
        champions.append_metrics(metrics, log, day)
    rows = metrics.read().collect()
    assert len(rows) == 2 and {r.n_predictions for r in rows} == {3} and len({r.version_id for r in rows}) == 2


def test_alerts_close_with_the_next_period(spark, tmp_path):
    log = RunLog(spark, str(tmp_path), schemas.ALERT_ROWS)
    metrics = metric_rows(spark, ("v1", 2001, 0.5, 0.9), ("v1", 2002, 0.9, 0.9), ("v2", 2002, 0.5, 0.9)).withColumn("drift_share", F.lit(0.1))
    champions.append_alerts(log, metrics.where("period = 2001"), ONE)
    champions.append_alerts(log, metrics.where("period = 2002"), TWO)
    found = {r.alert_id: (r.status, r.resolved_at, r.resolved_by) for r in champions.alert_states(log.read(), metrics).collect()}
    assert found == {"v1_auc_2001-12-31": ("resolved", dt.datetime(2002, 12, 31), "duebook"), "v2_auc_2002-12-31": ("open", None, None)}


@pytest.mark.parametrize("rows", [[(0.2, 0), (0.7, 1), (0.7, 0), (0.5, 1)], [(0.4, 1)], [(0.9, 0), (0.1, 0)], [(0.3, 1), (0.3, 0), (0.3, 1)]])
def test_score_report_equals_the_single_figures(spark, rows):
    scored = spark.createDataFrame([("a", s, y, int(s >= 0.5)) for s, y in rows], "version string, score double, label int, predicted int")
    by = ["version"]
    report = evaluate.score_report(scored, by, (0.4, 0.6)).first()
    single = evaluate.classification_metrics(scored, by).join(evaluate.auc(scored, by), by).join(evaluate.ks(scored, by), by)
    single = single.join(evaluate.average_precision(scored, by), by).join(evaluate.score_summary(scored, by).drop("n"), by).first()
    for name in ("n", "accuracy", "precision", "recall", "f1", "f1_weighted", "auc", "ks", "average_precision", "mean_score", "median_score"):
        assert report[name] == pytest.approx(single[name], abs=1e-9), name
    assert [report[f"band_{i}"] for i in range(3)] == [sum(s < 0.4 for s, _ in rows), sum(0.4 <= s < 0.6 for s, _ in rows), sum(s >= 0.6 for s, _ in rows)]


def test_metrics_read_the_cases_once(spark, folder):
    from duebook.plans import QUERIES

    plan = QUERIES["model_comparison"](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") <= 3
