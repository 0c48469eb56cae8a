"""Drift, metric log, alerts, promotion and experiments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.functions.keys import hash_bucket
from duebook.operators import drift, experiment, monitoring
from duebook.operators.scorecard import FEATURES, VARIANTS
from duebook.session import stage
from duebook.sources.ledger import PAID, Ledger

from .common_sql import view
from .evaluation import AREA, metrics_sql, ordered_sql, score_sql
from .indicators import priorities_of, scores_of
from .registry import query

TRAILING_DAYS = 3 * 365


def kolmogorov_sql(distance: str, n: str, m: str) -> str:
    lam = f"({distance} * sqrt(CAST({n} AS DOUBLE) * CAST({m} AS DOUBLE) / CAST({n} + {m} AS DOUBLE)))"
    series = f"list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1.0E0 ELSE -1.0E0 END) * exp(-2.0E0 * k * k * {lam} * {lam})))"
    return f"CASE WHEN {lam} < 0.2E0 THEN 1.0E0 ELSE least(greatest(2.0E0 * {series}, 0), 1) END"


def drift_sql(rows: str, by: str = "") -> str:
    """From rows ``(by, feature, value, is_current)``: the KS table."""
    lead = f"{by}, " if by else ""
    return f"""
SELECT {lead}feature, n_ref, n_cur, round(distance, 6) AS ks, round(p, 6) AS p_value, CAST(p < 0.05 AS INTEGER) AS has_drift,
  round(mean_ref, 6) AS mean_ref, round(mean_cur, 6) AS mean_cur,
  round((mean_cur - mean_ref) / nullif(mean_ref, 0) * 100, 4) AS mean_shift_pct
FROM (SELECT *, {kolmogorov_sql("distance", "n_ref", "n_cur")} AS p
  FROM (SELECT {lead}feature, CAST(max(n_ref) AS BIGINT) AS n_ref, CAST(max(n_cur) AS BIGINT) AS n_cur,
      max(abs(CAST(upto_cur AS DOUBLE) / CAST(n_cur AS DOUBLE) - CAST(upto_ref AS DOUBLE) / CAST(n_ref AS DOUBLE))) AS distance,
      sum(value * ref) / max(n_ref) AS mean_ref, sum(value * cur) / max(n_cur) AS mean_cur
    FROM (SELECT *, sum(ref) OVER (PARTITION BY {lead}feature ORDER BY value) AS upto_ref,
        sum(cur) OVER (PARTITION BY {lead}feature ORDER BY value) AS upto_cur,
        sum(ref) OVER (PARTITION BY {lead}feature) AS n_ref, sum(cur) OVER (PARTITION BY {lead}feature) AS n_cur
      FROM (SELECT {lead}feature, value, count(*) FILTER (NOT is_current) AS ref, count(*) FILTER (is_current) AS cur
        FROM {rows} WHERE value IS NOT NULL GROUP BY {lead}feature, value))
    WHERE n_ref > 0 AND n_cur > 0 GROUP BY {lead}feature))
"""


view(
    "event_halves",
    """
SELECT e.*, ts >= middle AS is_current, json_extract_string(props, '$.k') AS k
FROM events e, (SELECT date_trunc('day', make_timestamp((epoch_us(min(ts)) + epoch_us(max(ts))) // 2)) AS middle FROM events)
""",
)
view(
    "event_features",
    " UNION ALL ".join(
        f"SELECT '{name}' AS feature, CAST({expr} AS DOUBLE) AS value, is_current FROM event_halves"
        for name, expr in (("value", "value"), ("hour_of_day", "hour(ts)"), ("k", "k"))
    ),
    "event_halves",
)
view(
    "invoice_halves",
    """
SELECT i.*, issue_date >= middle AS is_current
FROM invoices i, (SELECT min(issue_date) + CAST(date_diff('day', min(issue_date), max(issue_date)) // 2 AS INTEGER) AS middle FROM invoices)
""",
    "invoices",
)
view(
    "drift_rows",
    """
SELECT feature, value, is_current FROM event_features
UNION ALL SELECT 'invoice_amount', CAST(amount AS DOUBLE), is_current FROM invoice_halves
""",
    "event_features",
    "invoice_halves",
)
view("drift_table", drift_sql("drift_rows"), "drift_rows")
view(
    "drift_totals",
    """
SELECT count(*) AS n_features, CAST(sum(has_drift) AS BIGINT) AS n_drifted,
  round(CAST(sum(has_drift) AS DOUBLE) / count(*), 6) AS drift_share,
  CAST(CAST(sum(has_drift) AS DOUBLE) / count(*) > 0.3 AS INTEGER) AS dataset_drift,
  max_by(feature, (ks, feature)) AS worst_feature
FROM drift_table
""",
    "drift_table",
)


def event_halves(book: Ledger) -> DataFrame:
    events = book.table("events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    ends = events.agg(F.min(micros).alias("first"), F.max(micros).alias("last")).first()
    middle = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=(ends["first"] + ends["last"]) // 2)
    # as text, so that the time zone of the driver plays no part
    return events.withColumn("is_current", F.col("ts") >= F.lit(f"{middle:%Y-%m-%d} 00:00:00").cast("timestamp_ntz"))


def invoice_halves(book: Ledger) -> DataFrame:
    invoices = book.invoices()
    ends = book.table("orders").agg(F.min("o_orderdate").cast("date").alias("first")).first()
    middle = ends["first"] + dt.timedelta(days=(book.as_of - ends["first"]).days // 2)
    return invoices.withColumn("is_current", F.col("issue_date") >= F.lit(middle))


def drift_of(book: Ledger) -> DataFrame:
    events = event_halves(book).select(
        "is_current",
        "value",
        F.hour("ts").alias("hour_of_day"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )
    amounts = invoice_halves(book).select("is_current", F.col("amount").cast("double").alias("invoice_amount"))
    return drift.feature_drift(events, ["value", "hour_of_day", "k"]).unionByName(
        drift.feature_drift(amounts, ["invoice_amount"])
    )


@query("drift_ks", "SELECT * FROM drift_table", ("drift_table",))
def drift_ks(book: Ledger) -> DataFrame:
    return drift_of(book).orderBy(F.desc("ks"), "feature")


@query("drift_summary", "SELECT * FROM drift_totals", ("drift_totals",))
def drift_summary(book: Ledger) -> DataFrame:
    return drift.drift_summary(drift_of(book))


ERF_SQL = (
    "(1.0E0 - (((((1.061405429E0 * {t} + -1.453152027E0) * {t} + 1.421413741E0) * {t} + -0.284496736E0) * {t}"
    " + 0.254829592E0) * {t}) * exp(-({x}) * ({x})))"
)


def cdf_sql(z: str) -> str:
    x = f"(abs({z}) / 1.4142135623730951E0)"
    erf = ERF_SQL.format(t=f"(1.0E0 / (1.0E0 + 0.3275911E0 * {x}))", x=x)
    return f"(0.5E0 * (1.0E0 + sign({z}) * {erf}))"


def chi2_sql(source: str, label: str) -> str:
    return f"""
SELECT sum((cur - expected) * (cur - expected) / expected) AS statistic, CAST(count(*) - 1 AS INTEGER) AS dof
FROM (SELECT cur, ref * 1.0E0 / sum(ref) OVER () * sum(cur) OVER () AS expected
  FROM (SELECT {label}, count(*) FILTER (NOT is_current) AS ref, count(*) FILTER (is_current) AS cur
    FROM {source} GROUP BY ALL))
"""


@query(
    "target_drift_chi2",
    f"""
SELECT target, round(statistic, 6) AS statistic, dof, round(p, 6) AS p_value, CAST(p < 0.05 AS INTEGER) AS has_drift
FROM (SELECT 'event_type' AS target, *, exp(-statistic / 2) * (1 + statistic / 2) AS p
    FROM ({chi2_sql("event_halves", "event_type")})
  UNION ALL
  SELECT 'paid', *, 2.0E0 * (1.0E0 - {cdf_sql("sqrt(statistic)")}) FROM ({chi2_sql("invoice_halves", "status = 'PAID' AS paid")}))
""",
    ("event_halves", "invoice_halves"),
)
def target_drift_chi2(book: Ledger) -> DataFrame:
    events = drift.class_drift(event_halves(book), "event_type", F.col("is_current"), "event_type")
    invoices = invoice_halves(book).withColumn("paid", F.col("status") == PAID)
    return events.unionByName(drift.class_drift(invoices, "paid", F.col("is_current"), "paid"))


view(
    "yearly",
    """
SELECT a.customer_id, a.period, a.late * 1.0E0 / a.n AS overdue_share, a.amount / a.n AS mean_amount, a.n AS n_known,
  CAST(b.late * 100 > b.n * 40 AS INTEGER) AS label
FROM by_year a JOIN by_year b ON b.customer_id = a.customer_id AND b.period = a.period + 1
""",
    "by_year",
)
view(
    "by_year",
    """
SELECT customer_id, CAST(year(issue_date) AS INTEGER) AS period, count(*) AS n, count(*) FILTER (status = 'OVERDUE') AS late,
  CAST(sum(amount) AS DOUBLE) AS amount
FROM invoices GROUP BY ALL
""",
    "invoices",
)
view(
    "yearly_scored",
    "SELECT *, CAST(score >= 0.5 AS INTEGER) AS predicted FROM ("
    + " UNION ALL ".join(f"SELECT *, '{v}' AS version, {score_sql(w)} AS score FROM yearly" for v, w in VARIANTS.items())
    + ")",
    "yearly",
)
view(
    "metric_log",
    f"""
SELECT m.version || '_' || CAST(m.period AS VARCHAR) AS metric_id, m.version, m.period,
  make_date(m.period, 1, 1) AS period_start, make_date(m.period, 12, 31) AS period_end, m.n AS n_predictions,
  s.* EXCLUDE (version, period), m.accuracy, m.precision, m.recall, m.f1, m.f1_weighted, a.auc
FROM ({metrics_sql("yearly_scored", "version, period")}) m
JOIN (SELECT version, period, count(*) FILTER (score >= 0.6) AS n_high_risk,
    count(*) FILTER (score >= 0.4 AND score < 0.6) AS n_medium_risk, count(*) FILTER (score < 0.4) AS n_low_risk,
    round(avg(score), 6) AS avg_score, round(quantile_cont(score, 0.5), 6) AS median_score,
    round(avg(label), 6) AS actual_default_rate, round(avg(predicted), 6) AS predicted_default_rate
  FROM yearly_scored GROUP BY version, period) s ON s.version = m.version AND s.period = m.period
JOIN (SELECT version, period, {AREA} AS auc FROM ({ordered_sql("yearly_scored", "version, period")}) GROUP BY version, period) a
  ON a.version = m.version AND a.period = m.period
""",
    "yearly_scored",
)
view(
    "period_rows",
    " UNION ALL ".join(
        f"SELECT period{' + 1' if not current else ''} AS period, '{f}' AS feature, CAST({f} AS DOUBLE) AS value, {current} AS is_current FROM yearly"
        for f in FEATURES
        for current in (True, False)
    ),
    "yearly",
)
view("period_drift", drift_sql("period_rows", "period"), "period_rows")
view(
    "drift_log",
    """
SELECT l.*, d.drift_share FROM metric_log l LEFT JOIN (
  SELECT period, round(CAST(sum(has_drift) AS DOUBLE) / count(*), 6) AS drift_share FROM period_drift GROUP BY period) d
ON d.period = l.period
""",
    "metric_log",
    "period_drift",
)


def rule_sql(kind: str, metric: str, test: str, limit, severity: str, word: str) -> str:
    return f"""
SELECT version, period_end, CASE WHEN period = max(period) OVER (PARTITION BY version) THEN 'open' ELSE 'resolved' END AS status,
  '{kind}' AS alert_type, {severity} AS severity, '{metric}' AS metric_name, CAST({metric} AS DOUBLE) AS current_value,
  CAST({limit} AS DOUBLE) AS threshold_value, round(CAST({metric} AS DOUBLE) - {float(limit)!r}E0, 6) AS deviation,
  '{metric} ' || CAST({metric} AS VARCHAR) || ' {word} {limit}' AS message
FROM drift_log QUALIFY {metric} {test} {limit}
"""


view(
    "fired",
    " UNION ALL ".join(
        (
            rule_sql("performance", "auc", "<", 0.75, "'high'", "below"),
            rule_sql("performance", "f1", "<", 0.65, "'high'", "below"),
            rule_sql("drift", "drift_share", ">", 0.3, "CASE WHEN drift_share > 0.5 THEN 'critical' ELSE 'high' END", "above"),
            rule_sql("volume", "n_predictions", "<", 50, "'medium'", "below"),
            rule_sql("volume", "n_predictions", ">", 2000, "'medium'", "above"),
        )
    ),
    "drift_log",
)
view(
    "decisions",
    """
SELECT *, CAST(greatest(auc_gain, f1_gain) > 0.02 AS INTEGER) AS approved,
  CAST(least(auc_gain, f1_gain) >= -0.02 AS INTEGER) AS no_metric_worse,
  CASE WHEN greatest(auc_gain, f1_gain) > 0.02 THEN 'approved: ' || CASE WHEN auc_gain >= f1_gain THEN 'auc' ELSE 'f1' END
    || ' gains ' || CAST(greatest(auc_gain, f1_gain) AS VARCHAR) ELSE 'denied: no gain above 0.02' END AS reason
FROM (SELECT period, version, lag(version) OVER w AS baseline, round(auc - lag(auc) OVER w, 6) AS auc_gain,
    round(f1 - lag(f1) OVER w, 6) AS f1_gain
  FROM metric_log WINDOW w AS (PARTITION BY period ORDER BY version))
WHERE baseline IS NOT NULL
""",
    "metric_log",
)
view(
    "version_log",
    """
SELECT 'default_scorecard_v' || CAST(version_number AS VARCHAR) AS version_id, version_number, 'default_scorecard' AS model,
  trained_on, variant, auc, f1, precision, recall,
  CASE WHEN version_number = 1 OR approved = 1 THEN 'production' ELSE 'staging' END AS status
FROM (SELECT CAST(row_number() OVER (ORDER BY l.period, l.version) AS INTEGER) AS version_number, l.period_end AS trained_on,
    l.version AS variant, l.auc, l.f1, l.precision, l.recall, d.approved
  FROM metric_log l LEFT JOIN decisions d ON d.period = l.period AND d.version = l.version)
""",
    "metric_log",
    "decisions",
)


def cases_of(book: Ledger) -> DataFrame:
    return stage(monitoring.yearly_cases(book.invoices()))


def log_of(book: Ledger) -> DataFrame:
    """Some dozens of rows that several rules read."""
    return stage(monitoring.metric_log(cases_of(book)).select(*monitoring.log_columns()))


def drift_log_of(book: Ledger) -> DataFrame:
    cases = cases_of(book)
    log = monitoring.metric_log(cases).select(*monitoring.log_columns())
    return stage(monitoring.with_drift_share(log, monitoring.period_drift(cases)))


@query(
    "production_metrics",
    f"SELECT {', '.join(monitoring.log_columns())} FROM metric_log",
    ("metric_log",),
)
def production_metrics(book: Ledger) -> DataFrame:
    return monitoring.metric_log(cases_of(book)).select(*monitoring.log_columns())


@query(
    "metric_trends",
    f"""
SELECT period_end, version, round(avg(auc), 6) AS avg_auc, round(avg(f1), 6) AS avg_f1,
  round(avg(precision), 6) AS avg_precision, round(avg(recall), 6) AS avg_recall,
  CAST(sum(n_predictions) AS BIGINT) AS total_predictions
FROM metric_log, params WHERE period_end >= as_of - {TRAILING_DAYS} GROUP BY period_end, version
""",
    ("metric_log", "params"),
)
def metric_trends(book: Ledger) -> DataFrame:
    log = monitoring.metric_log(cases_of(book))
    return monitoring.metric_trends(monitoring.trailing(log, "period_end", book.as_of, TRAILING_DAYS))


@query(
    "score_distribution",
    f"""
SELECT version, period_start, round(n_low_risk * 100.0E0 / n_predictions, 4) AS pct_low_risk,
  round(n_medium_risk * 100.0E0 / n_predictions, 4) AS pct_medium_risk,
  round(n_high_risk * 100.0E0 / n_predictions, 4) AS pct_high_risk, avg_score,
  round(predicted_default_rate * 100, 4) AS predicted_default_pct, n_predictions
FROM metric_log, params WHERE period_start >= as_of - {TRAILING_DAYS}
""",
    ("metric_log", "params"),
)
def score_distribution(book: Ledger) -> DataFrame:
    log = monitoring.metric_log(cases_of(book))
    return monitoring.score_distribution(monitoring.trailing(log, "period_start", book.as_of, TRAILING_DAYS))


@query("alert_rules", "SELECT * FROM fired", ("fired",))
def alert_rules(book: Ledger) -> DataFrame:
    return monitoring.alerts(drift_log_of(book))


@query(
    "open_alerts",
    """
SELECT * FROM fired WHERE status = 'open'
ORDER BY CASE severity WHEN 'critical' THEN 1 WHEN 'high' THEN 2 WHEN 'medium' THEN 3 ELSE 4 END, period_end DESC, version
""",
    ("fired",),
)
def open_alerts(book: Ledger) -> DataFrame:
    return monitoring.open_alerts(monitoring.alerts(drift_log_of(book)))


@query(
    "alert_summary",
    f"""
SELECT alert_type, severity, count(*) AS n_alerts, count(*) FILTER (status = 'open') AS n_open,
  count(*) FILTER (status = 'resolved') AS n_resolved, max(period_end) AS last_alert
FROM fired, params WHERE period_end >= as_of - {TRAILING_DAYS} GROUP BY alert_type, severity
""",
    ("fired", "params"),
)
def alert_summary(book: Ledger) -> DataFrame:
    fired = monitoring.alerts(drift_log_of(book))
    return monitoring.alert_summary(monitoring.trailing(fired, "period_end", book.as_of, TRAILING_DAYS))


@query(
    "rollback_signals",
    """
SELECT *, greatest(auc_low, volume_drop, drift_critical) AS roll_back FROM (
  SELECT version, period, CAST(auc < 0.7 AS INTEGER) AS auc_low,
    CAST(coalesce(n_predictions < 0.5 * lag(n_predictions) OVER (PARTITION BY version ORDER BY period), FALSE) AS INTEGER) AS volume_drop,
    CAST(coalesce(drift_share > 0.5, FALSE) AS INTEGER) AS drift_critical
  FROM drift_log)
""",
    ("drift_log",),
)
def rollback_signals(book: Ledger) -> DataFrame:
    return monitoring.rollback_signals(drift_log_of(book))


@query("promotion_decision", "SELECT * FROM decisions", ("decisions",))
def promotion_decision(book: Ledger) -> DataFrame:
    return monitoring.promotion_decisions(log_of(book))


@query("model_versions", "SELECT * FROM version_log", ("version_log",))
def model_versions(book: Ledger) -> DataFrame:
    return monitoring.version_log(log_of(book))


@query(
    "current_champion",
    """
SELECT model, CASE WHEN place = 1 THEN 'champion' ELSE 'challenger' END AS alias, version_id, version_number, variant, auc, f1
FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY version_number DESC) AS place FROM version_log
  WHERE status = 'production')
WHERE place <= 2
""",
    ("version_log",),
)
def current_champion(book: Ledger) -> DataFrame:
    return monitoring.current_champion(monitoring.version_log(log_of(book)))


@query(
    "monitoring_log",
    """
SELECT n_drifted, n_features, n_predictions, mean_probability, critical_pct,
  round(n_drifted * 100.0E0 / n_features, 4) AS drift_pct, CAST(n_drifted > 0 AS INTEGER) AS drift_alert,
  CAST(critical_pct > 30 AS INTEGER) AS critical_alert,
  CASE WHEN n_drifted > 3 OR critical_pct > 30 THEN 'CRITICAL' ELSE 'OK' END AS status
FROM drift_totals, (SELECT count(*) AS n_predictions, round(avg(probability), 6) AS mean_probability,
    round(count(*) FILTER (category = 'At risk') * 100.0E0 / count(*), 4) AS critical_pct FROM customer_scores)
""",
    ("drift_totals", "customer_scores"),
)
def monitoring_log(book: Ledger) -> DataFrame:
    summary = drift.drift_summary(drift_of(book))
    return monitoring.monitoring_record(summary, scores_of(book), F.col("category") == "At risk")


MD5 = "CAST('0x' || substr(md5({}), 1, 8) AS BIGINT)"


@query(
    "ab_population",
    f"""
SELECT customer_id, probability, predicted_value, priority,
  CASE WHEN {MD5.format("CAST(customer_id AS VARCHAR)")} % 2 = 1 THEN 'treatment' ELSE 'control' END AS arm,
  CASE WHEN {MD5.format("'route' || CAST(customer_id AS VARCHAR)")} % 100 < 10 THEN 'challenger' ELSE 'champion' END AS route
FROM priorities WHERE priority IN ('Critical', 'High')
""",
    ("priorities",),
)
def ab_population(book: Ledger) -> DataFrame:
    chosen = priorities_of(book).filter(F.col("priority").isin("Critical", "High"))
    cols = ["customer_id", "probability", "predicted_value", "priority"]
    return experiment.assign_arms(chosen.select(*cols), "customer_id")


@query(
    "ab_ztest",
    f"""
SELECT n_control, n_treatment, round(p0, 6) AS rate_control, round(p1, 6) AS rate_treatment,
  round((p0 - p1) / p0, 6) AS relative_lift, round(p0 - p1 - 1.96E0 * se_diff, 6) AS ci_low,
  round(p0 - p1 + 1.96E0 * se_diff, 6) AS ci_high, round(z, 6) AS z_stat, round(1.0E0 - {cdf_sql("z")}, 6) AS p_value,
  CAST(1.0E0 - {cdf_sql("z")} < 0.05 AS INTEGER) AS significant
FROM (SELECT *, (p0 - p1) / sqrt(pooled * (1 - pooled) * (1.0E0 / n_control + 1.0E0 / n_treatment)) AS z,
    sqrt(p0 * (1 - p0) / n_control + p1 * (1 - p1) / n_treatment) AS se_diff
  FROM (SELECT *, x0 * 1.0E0 / n_control AS p0, x1 * 1.0E0 / n_treatment AS p1,
      (x0 + x1) * 1.0E0 / (n_control + n_treatment) AS pooled
    FROM (SELECT count(*) FILTER (arm = 0) AS n_control, count(*) FILTER (arm = 1) AS n_treatment,
        count(*) FILTER (arm = 0 AND event_type = 'error') AS x0, count(*) FILTER (arm = 1 AND event_type = 'error') AS x1
      FROM (SELECT event_type, {MD5.format("CAST(user_id AS VARCHAR)")} % 2 AS arm FROM events))))
""",
)
def ab_ztest(book: Ledger) -> DataFrame:
    events = book.table("events").select("user_id", "event_type")
    treated = hash_bucket(F.col("user_id"), 2) == 1
    return experiment.two_proportion_test(events, treated, F.col("event_type") == "error")
