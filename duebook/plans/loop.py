"""The closed scoring loop over the source tables: versions, predictions, metrics and alerts, each run appended.

Training runs end with a year, scoring runs fall on the as-of date and on the same date one year before. The last run of
each kind is repeated, which must change nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.operators import champions, monitoring, ranking
from duebook.operators.scorecard import VARIANTS
from duebook.session import workspace
from duebook.sources import schemas
from duebook.sources.ledger import Ledger
from duebook.sources.runs import RunLog
from duebook.streaming import scoring

from .common_sql import view
from .evaluation import AREA, metrics_sql, ordered_sql, point_in_time_of, score_sql
from .monitoring import drift_log_of, log_of
from .registry import query


def year_end(year: int) -> dt.date:
    return dt.date(year, 12, 31)


def year_runs(log: DataFrame) -> list[tuple[dt.date, DataFrame]]:
    """The metric log in two training runs, all years but the last one and the last one, which runs twice."""
    last = log.agg(F.max("period").alias("last")).first()["last"]
    earlier, newest = log.where(F.col("period") < last), log.where(F.col("period") == last)
    return [(year_end(last - 1), earlier), (year_end(last), newest), (year_end(last), newest)]


def scoring_dates(as_of: dt.date) -> list[dt.date]:
    return [as_of - dt.timedelta(days=365), as_of, as_of]


def trained(book: Ledger) -> tuple[RunLog, str]:
    """The version log after all training runs, and the folder of the saved pipelines."""
    root = workspace(book.spark, "versions")
    log = RunLog(book.spark, f"{root}/log", schemas.VERSION_ROWS)
    for run_date, metrics in year_runs(log_of(book)):
        champions.append_versions(log, metrics, run_date, root)
    return log, root


def predicted(book: Ledger) -> RunLog:
    """The predictions of all scoring runs."""
    versions, models = trained(book)
    log = RunLog(book.spark, workspace(book.spark, "predictions"), schemas.PREDICTION_ROWS)
    for run_date in scoring_dates(book.as_of):
        facts = ranking.customer_facts(book.invoices(), run_date)
        champions.append_predictions(log, versions, models, facts, run_date)
    return log


def shown(rows: DataFrame) -> DataFrame:
    """Moments as dates, as every run falls on one."""
    moments = [f.name for f in rows.schema.fields if f.dataType == schemas.MOMENT]
    return rows.withColumns({name: F.col(name).cast("date") for name in moments})


view(
    "version_rows",
    """
SELECT v.*, CASE WHEN v.status = 'production' THEN v.trained_on END AS deployed_on,
  CASE WHEN v.status = 'production' THEN min(CASE WHEN v.status = 'production' THEN v.trained_on END) OVER (
    ORDER BY v.version_number ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) END AS retired_on,
  l.n_predictions, l.period_start, coalesce(d.reason, 'no version to compare with') AS reason,
  CASE WHEN v.trained_on = max(v.trained_on) OVER () THEN max(v.trained_on) OVER ()
    ELSE make_date(year(max(v.trained_on) OVER ()) - 1, 12, 31) END AS run_on
FROM version_log v JOIN metric_log l ON l.period_end = v.trained_on AND l.version = v.variant
LEFT JOIN decisions d ON d.period = l.period AND d.version = l.version
""",
    "version_log",
    "metric_log",
    "decisions",
)


@query(
    "version_log_appended",
    """
SELECT version_id, version_number, model, variant, trained_on AS trained_at, period_start AS data_start,
  trained_on AS data_end, n_predictions AS n_training, auc, f1, precision, recall,
  CASE WHEN status = 'production' THEN 'models/' || version_id END AS model_path,
  CASE WHEN retired_on IS NOT NULL THEN 'retired' ELSE status END AS status, deployed_on AS deployed_at,
  retired_on AS retired_at, reason AS notes, run_on AS created_at, 'duebook' AS created_by, CAST(run_on AS VARCHAR) AS run_id
FROM version_rows
""",
    ("version_rows",),
)
def version_log_appended(book: Ledger) -> DataFrame:
    log, _ = trained(book)
    return shown(champions.version_states(log.read()))


view(
    "run_facts",
    """
SELECT customer_id, run_on,
  CASE WHEN recency < 90 THEN CASE WHEN recency < 60 THEN 'Premium' ELSE 'Regular' END ELSE 'At risk' END AS category,
  late * 1.0E0 / n AS overdue_share, amount / n AS mean_amount, n AS n_known, CAST(late * 100 > n * 40 AS INTEGER) AS label
FROM (SELECT customer_id, run_on, count(*) AS n, count(*) FILTER (status = 'OVERDUE') AS late,
    CAST(sum(amount) AS DOUBLE) AS amount, date_diff('day', max(issue_date), run_on) AS recency
  FROM invoices, (SELECT as_of AS run_on FROM params UNION ALL SELECT as_of - 365 FROM params)
  WHERE issue_date <= run_on GROUP BY customer_id, run_on)
""",
    "invoices",
    "params",
)
view(
    "run_champions",
    """
SELECT run_on, max_by(version_id, version_number) AS version_id, max_by(variant, version_number) AS variant
FROM (SELECT DISTINCT run_on FROM run_facts) f JOIN (SELECT * EXCLUDE (run_on), run_on AS known_on FROM version_rows
  WHERE status = 'production') v ON v.known_on <= f.run_on
GROUP BY run_on
""",
    "run_facts",
    "version_rows",
)
view(
    "run_predictions",
    "SELECT *, CAST(score >= 0.5 AS INTEGER) AS predicted FROM (SELECT f.*, c.version_id, CASE c.variant "
    + " ".join(f"WHEN '{name}' THEN {score_sql(weights)}" for name, weights in VARIANTS.items())
    + " END AS score FROM run_facts f JOIN run_champions c ON c.run_on = f.run_on)",
    "run_facts",
    "run_champions",
)


@query(
    "predictions_log",
    """
SELECT customer_id, category, score AS probability, predicted, label, version_id, run_on AS created_at,
  'duebook' AS created_by, CAST(run_on AS VARCHAR) AS run_id
FROM run_predictions
""",
    ("run_predictions",),
)
def predictions_log(book: Ledger) -> DataFrame:
    return shown(predicted(book).read())


def figures_sql(source: str, by: str) -> str:
    """Metric log figures of scored rows."""
    on = " AND ".join(f"{{0}}.{c} = m.{c}" for c in by.split(", "))
    return f"""
SELECT m.{by.replace(", ", ", m.")}, m.n AS n_predictions, s.* EXCLUDE ({by}), m.accuracy, m.precision, m.recall, m.f1, a.auc
FROM ({metrics_sql(source, by)}) m
JOIN (SELECT {by}, count(*) FILTER (score >= 0.6) AS n_high_risk,
    count(*) FILTER (score >= 0.4 AND score < 0.6) AS n_medium_risk, count(*) FILTER (score < 0.4) AS n_low_risk,
    round(avg(score), 6) AS avg_score, round(quantile_cont(score, 0.5), 6) AS median_score,
    round(avg(label), 6) AS actual_default_rate, round(avg(predicted), 6) AS predicted_default_rate
  FROM {source} GROUP BY {by}) s ON {on.format("s")}
JOIN (SELECT {by}, {AREA} AS auc FROM ({ordered_sql(source, by)}) GROUP BY {by}) a ON {on.format("a")}
"""


@query(
    "metric_log_appended",
    f"""
SELECT version_id || '_' || CAST(run_on AS VARCHAR) AS metric_id, run_on AS "timestamp", 'daily' AS period_type,
  run_on AS period_start, run_on AS period_end, f.* EXCLUDE (run_on), run_on AS created_at, 'duebook' AS created_by,
  CAST(run_on AS VARCHAR) AS run_id
FROM ({figures_sql("run_predictions", "version_id, run_on")}) f
""",
    ("run_predictions",),
)
def metric_log_appended(book: Ledger) -> DataFrame:
    predictions = predicted(book)
    log = RunLog(book.spark, workspace(book.spark, "metrics"), schemas.METRIC_ROWS)
    for run_date in scoring_dates(book.as_of):
        champions.append_metrics(log, predictions, run_date)
    return shown(log.read())


@query(
    "alert_log_appended",
    """
SELECT f.version || '_' || metric_name || '_' || CAST(f.period_end AS VARCHAR) AS alert_id, f.period_end AS "timestamp",
  alert_type, severity, metric_name, current_value, threshold_value, deviation, f.version,
  make_date(year(f.period_end), 1, 1) AS period_start, f.period_end, message,
  CASE WHEN next_end IS NULL THEN 'open' ELSE 'resolved' END AS status, next_end AS resolved_at,
  CASE WHEN next_end IS NOT NULL THEN 'duebook' END AS resolved_by, run_on AS created_at, 'duebook' AS created_by,
  CAST(run_on AS VARCHAR) AS run_id
FROM fired f JOIN (SELECT version, period_end, lead(period_end) OVER (PARTITION BY version ORDER BY period_end) AS next_end,
    CASE WHEN period_end = max(period_end) OVER () THEN period_end
      ELSE make_date(year(max(period_end) OVER ()) - 1, 12, 31) END AS run_on
  FROM metric_log) l ON l.version = f.version AND l.period_end = f.period_end
""",
    ("fired", "metric_log"),
)
def alert_log_appended(book: Ledger) -> DataFrame:
    log = RunLog(book.spark, workspace(book.spark, "alerts"), schemas.ALERT_ROWS)
    metrics = drift_log_of(book)
    for run_date, rows in year_runs(metrics):
        champions.append_alerts(log, rows, run_date)
    return shown(champions.alert_states(log.read(), metrics))


view(
    "requests_scored",
    "SELECT *, CAST(score >= 0.5 AS INTEGER) AS predicted FROM (SELECT p.customer_id, p.label, c.version_id, CASE c.variant "
    + " ".join(f"WHEN '{name}' THEN {score_sql(weights)}" for name, weights in VARIANTS.items())
    + " END AS score FROM point_in_time p, run_champions c, params WHERE c.run_on = as_of)",
    "point_in_time",
    "run_champions",
    "params",
)


@query(
    "stream_scored_metrics",
    f"""
SELECT version_id, n_predictions, n_high_risk, n_medium_risk, n_low_risk, avg_score, median_score, accuracy, precision,
  recall, f1, auc, actual_default_rate, predicted_default_rate
FROM ({figures_sql("requests_scored", "version_id")})
""",
    ("requests_scored",),
)
def stream_scored_metrics(book: Ledger) -> DataFrame:
    """Requests are scored as they arrive by the saved champion; once labels are known, the scores give the metric row."""
    versions, models = trained(book)
    model, version_id = champions.load_champion(versions, models, book.as_of.isoformat())
    root = workspace(book.spark, "scored-requests")
    cases = point_in_time_of(book)
    requests = cases.drop("label")
    requests.write.parquet(f"{root}/requests")

    def score(rows: DataFrame) -> DataFrame:
        return model.transform(rows).select("customer_id", "score", F.lit(version_id).alias("version_id"))

    for _ in range(2):
        scoring.score_requests(book.spark, f"{root}/requests", requests.schema, score, f"{root}/scores", f"{root}/checkpoint")
    scores = book.spark.read.parquet(f"{root}/scores").join(cases.select("customer_id", "label"), "customer_id")
    rows = scores.select(F.col("version_id").alias("version"), F.lit(book.as_of.year).alias("period"), "score", "label")
    names = [n for n in schemas.METRIC_ROWS.names if n.startswith("n_") or n.endswith(("_score", "_rate"))]
    figures = monitoring.scored_metrics(rows).withColumnRenamed("version", "version_id")
    return figures.select("version_id", *names, "accuracy", "precision", "recall", "f1", "auc")
