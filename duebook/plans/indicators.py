"""Value at risk, rankings, ageing, money indicators and feature profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.operators import describe, ranking
from duebook.operators.features import add_recency_score
from duebook.sources.ledger import Ledger

from .common_sql import view
from .foundation import features_of, silver_of
from .registry import query

view(
    "customer_scores",
    """
SELECT customer_id, category, score AS probability, CAST(score >= 0.5 AS INTEGER) AS predicted, label FROM (
  SELECT customer_id,
    CASE WHEN recency < 90 THEN CASE WHEN recency < 60 THEN 'Premium' ELSE 'Regular' END ELSE 'At risk' END AS category,
    round(1.0E0 / (1.0E0 + exp(-(-1.2E0 + 2.0E0 * (late * 1.0E0 / n) + 0.1E0 * ((amount / n) / 100000.0E0)
      + 0.05E0 * (n / 10.0E0)))), 6) AS score,
    CAST(late * 100 > n * 40 AS INTEGER) AS label
  FROM (SELECT customer_id, count(*) AS n, count(*) FILTER (status = 'OVERDUE') AS late,
      CAST(sum(amount) AS DOUBLE) AS amount, date_diff('day', max(issue_date), max(as_of)) AS recency
    FROM invoices, params WHERE issue_date <= as_of GROUP BY customer_id))
""",
    "invoices",
    "params",
)

view(
    "risk_values",
    """
SELECT customer_id, actual_value, predicted_value, round(abs(actual_value - predicted_value), 6) AS abs_error,
  CASE WHEN predicted_value <= 0 THEN 'None' WHEN predicted_value <= 250000 THEN 'Low'
    WHEN predicted_value <= 1000000 THEN 'Medium' ELSE 'High' END AS money_band
FROM (SELECT customer_id, round(billed * rate / 100, 6) AS actual_value, predicted_value FROM (
  SELECT customer_id,
    CAST(sum(CASE WHEN date_diff('day', issue_date, as_of) <= 90 THEN total_amount ELSE 0 END) AS DOUBLE) AS billed,
    round(CAST(count(*) FILTER (status = 'OVERDUE') AS DOUBLE) / count(*) * 100, 2) AS rate,
    CAST(sum(open_amount) AS DOUBLE) AS predicted_value
  FROM silver, params WHERE issue_date <= as_of GROUP BY customer_id))
""",
    "silver",
    "params",
)

view(
    "priorities",
    """
SELECT *, CASE WHEN priority_score >= 400000 THEN 'Critical' WHEN priority_score >= 150000 THEN 'High'
  WHEN priority_score >= 40000 THEN 'Medium' ELSE 'Low' END AS priority
FROM (SELECT s.*, v.predicted_value, v.money_band, greatest(v.predicted_value, 0) AS adjusted_value,
    s.probability * greatest(v.predicted_value, 0) AS priority_score
  FROM customer_scores s JOIN risk_values v ON v.customer_id = s.customer_id)
""",
    "customer_scores",
    "risk_values",
)

view(
    "ranked",
    "SELECT *, row_number() OVER (ORDER BY priority_score DESC, customer_id) AS ranking FROM priorities",
    "priorities",
)


def scores_of(book: Ledger) -> DataFrame:
    return ranking.score_customers(book.invoices(), book.as_of)


def values_of(book: Ledger) -> DataFrame:
    invoices = silver_of(book, method=False, late=False)
    return ranking.value_at_risk(invoices, book.as_of, ranking.SCALED_MONEY_EDGES)


def priorities_of(book: Ledger) -> DataFrame:
    return ranking.prioritise(scores_of(book), values_of(book), ranking.SCALED_PRIORITY_STEPS)


@query("score_customers", "SELECT * FROM customer_scores", ("customer_scores",))
def score_customers(book: Ledger) -> DataFrame:
    return scores_of(book)


@query("value_at_risk_bands", "SELECT * FROM risk_values", ("risk_values",))
def value_at_risk_bands(book: Ledger) -> DataFrame:
    return values_of(book)


RANKING_COLUMNS = (
    "ranking",
    "customer_id",
    "category",
    "probability",
    "predicted_value",
    "priority_score",
    "priority",
    "predicted",
    "money_band",
)


@query("collections_ranking", f"SELECT {', '.join(RANKING_COLUMNS)} FROM ranked", ("ranked",))
def collections_ranking(book: Ledger) -> DataFrame:
    return ranking.rank_collections(priorities_of(book)).select(*RANKING_COLUMNS)


@query(
    "collections_top10",
    """
SELECT customer_id, probability, predicted_value, priority_score, priority FROM ranked WHERE ranking <= 10
""",
    ("ranked",),
)
def collections_top10(book: Ledger) -> DataFrame:
    best = priorities_of(book).orderBy(F.desc("priority_score"), "customer_id").limit(10)
    return best.select("customer_id", "probability", "predicted_value", "priority_score", "priority")


@query(
    "value_top10",
    """
SELECT customer_id, actual_value, predicted_value, abs_error, money_band
FROM risk_values ORDER BY predicted_value DESC NULLS LAST, customer_id LIMIT 10
""",
    ("risk_values",),
)
def value_top10(book: Ledger) -> DataFrame:
    """The ten customers of the largest predicted value."""
    return values_of(book).orderBy(F.desc_nulls_last("predicted_value"), "customer_id").limit(10)


@query(
    "priority_rollup",
    """
SELECT priority, count(*) AS n_customers,
  CAST(sum(CAST(adjusted_value AS DECIMAL(18,4))) AS DOUBLE) AS value_at_risk
FROM priorities GROUP BY priority
""",
    ("priorities",),
)
def priority_rollup(book: Ledger) -> DataFrame:
    return ranking.priority_rollup(priorities_of(book))


@query(
    "extreme_cases",
    """
SELECT customer_id, probability, predicted, label, 'highest' AS case_kind
FROM (SELECT * FROM customer_scores ORDER BY probability DESC, customer_id LIMIT 5)
UNION ALL
SELECT customer_id, probability, predicted, label, 'lowest'
FROM (SELECT * FROM customer_scores ORDER BY probability, customer_id LIMIT 5)
UNION ALL
SELECT customer_id, probability, predicted, label, 'borderline'
FROM (SELECT * FROM customer_scores ORDER BY abs(probability - 0.5E0), customer_id LIMIT 1)
""",
    ("customer_scores",),
)
def extreme_cases(book: Ledger) -> DataFrame:
    return ranking.extreme_cases(scores_of(book))


@query(
    "ageing_buckets",
    """
SELECT CASE WHEN days_late <= 30 THEN '0-30' WHEN days_late <= 60 THEN '31-60' WHEN days_late <= 90 THEN '61-90'
    ELSE '90+' END AS ageing,
  count(*) AS n_invoices, CAST(sum(total_amount) AS DOUBLE) AS total_amount, CAST(sum(open_amount) AS DOUBLE) AS open_amount
FROM silver WHERE status = 'OVERDUE' GROUP BY 1
""",
    ("silver",),
)
def ageing_buckets(book: Ledger) -> DataFrame:
    return ranking.ageing(silver_of(book, method=False))


@query(
    "kpi_block",
    """
SELECT count(*) AS n_invoices,
  round(CAST(sum(total_amount) FILTER (status = 'OVERDUE') AS DOUBLE) / CAST(sum(total_amount) AS DOUBLE) * 100, 4)
    AS overdue_value_pct,
  round(CAST(sum(total_amount) FILTER (status = 'OVERDUE') AS DOUBLE) / count(*) FILTER (status = 'OVERDUE'), 4)
    AS mean_overdue_ticket,
  round(CAST(sum(greatest(open_amount, 0)) FILTER (status <> 'PAID') AS DOUBLE) / CAST(sum(total_amount) AS DOUBLE) * 100, 4)
    AS delinquency_pct,
  (SELECT round(sum(priority_score), 2) FROM priorities) AS expected_loss,
  (SELECT count(*) FROM priorities WHERE probability > 0.6) AS n_high_probability
FROM silver
""",
    ("silver", "priorities"),
)
def kpi_block(book: Ledger) -> DataFrame:
    return ranking.money_indicators(silver_of(book, method=False, late=False), priorities_of(book))


@query(
    "label_prevalence",
    """
SELECT category, count(*) AS n_customers, CAST(sum(CAST(overdue_rate > 40 AS INTEGER)) AS BIGINT) AS n_overdue_label,
  round(100.0E0 * sum(CAST(overdue_rate > 40 AS INTEGER)) / count(*), 2) AS overdue_label_pct
FROM rfm GROUP BY category
""",
    ("rfm",),
)
def label_prevalence(book: Ledger) -> DataFrame:
    labelled = add_recency_score(features_of(book)).withColumn("y", (F.col("overdue_rate") > 40).cast("int"))
    return labelled.groupBy("category").agg(
        F.count(F.lit(1)).alias("n_customers"),
        F.sum("y").alias("n_overdue_label"),
        F.round(F.lit(100.0) * F.sum("y") / F.count(F.lit(1)), 2).alias("overdue_label_pct"),
    )


DESCRIBED = ("billed_90d", "billed_365d", "n_invoices", "avg_amount", "max_amount", "pay_rate", "overdue_rate",
             "recency_days")


@query(
    "feature_describe",
    "\nUNION ALL\n".join(
        f"""SELECT '{f}' AS feature, count({f}) AS n, round(avg({f}), 4) AS mean, round(stddev_samp({f}), 4) AS sd,
  CAST(min({f}) AS DOUBLE) AS min, CAST(max({f}) AS DOUBLE) AS max,
  round(quantile_cont(CAST({f} AS DOUBLE), 0.25), 6) AS q1, round(quantile_cont(CAST({f} AS DOUBLE), 0.5), 6) AS median,
  round(quantile_cont(CAST({f} AS DOUBLE), 0.75), 6) AS q3 FROM features"""
        for f in DESCRIBED
    ),
    ("features",),
)
def feature_describe(book: Ledger) -> DataFrame:
    return describe.describe_features(features_of(book), DESCRIBED)


CORRELATED = ("billed_90d", "n_invoices", "pay_rate", "overdue_rate", "avg_amount", "sd_amount")


@query(
    "correlation_matrix",
    "\nUNION ALL\n".join(
        f"SELECT '{a}' AS left_feature, '{b}' AS right_feature, round(corr({a}, {b}), 6) AS correlation FROM features"
        for i, a in enumerate(CORRELATED)
        for b in CORRELATED[i + 1 :]
    ),
    ("features",),
)
def correlation_matrix(book: Ledger) -> DataFrame:
    return describe.correlation_pairs(features_of(book), CORRELATED)


SCANNED = ("billed_90d", "billed_180d", "billed_365d", "n_invoices", "n_paid", "n_pending", "n_overdue", "avg_amount",
           "sd_amount", "min_amount", "max_amount", "pay_rate", "overdue_rate")


@query(
    "leakage_scan",
    "SELECT feature, correlation, CAST(abs(correlation) > 0.95 AS INTEGER) AS suspicious FROM ("
    + " UNION ALL ".join(
        f"SELECT '{f}' AS feature, round(corr({f}, CAST(overdue_rate > 40 AS INTEGER)), 6) AS correlation FROM features"
        for f in SCANNED
    )
    + ") ORDER BY abs(correlation) DESC, feature LIMIT 10",
    ("features",),
)
def leakage_scan(book: Ledger) -> DataFrame:
    labelled = features_of(book).withColumn("label", (F.col("overdue_rate") > 40).cast("int"))
    return describe.leakage_scan(labelled, SCANNED, "label")


CLUSTERED = ("billed_90d", "n_invoices", "pay_rate", "overdue_rate", "recency_days", "recency_score")


@query(
    "zscored_features",
    "SELECT customer_id, "
    + ", ".join(
        f"round(coalesce(({f} - avg({f}) OVER ()) / nullif(stddev_samp({f}) OVER (), 0), 0), 6) AS {f}" for f in CLUSTERED
    )
    + " FROM (SELECT customer_id, "
    + ", ".join(f"CAST(coalesce({f}, 0) AS DOUBLE) AS {f}" for f in CLUSTERED)
    + " FROM rfm)",
    ("rfm",),
)
def zscored_features(book: Ledger) -> DataFrame:
    return describe.zscores(add_recency_score(features_of(book)), "customer_id", CLUSTERED)


SECTORS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@query(
    "one_hot_sector",
    "SELECT customer_id, "
    + ", ".join(f"CAST(sector = '{s}' AS INTEGER) AS sector_{s}" for s in SECTORS)
    + " FROM customers",
    ("customers",),
)
def one_hot_sector(book: Ledger) -> DataFrame:
    return describe.one_hot(book.customers().select("customer_id", "sector"), "customer_id", "sector")


@query(
    "regression_metrics",
    """
SELECT count(*) AS n, round(avg(abs(e)), 4) AS mae, round(sqrt(avg(e * e)), 4) AS rmse,
  round(1.0E0 - sum(e * e) / (var_pop(actual_value) * count(*)), 6) AS r2
FROM (SELECT *, actual_value - predicted_value AS e FROM risk_values)
""",
    ("risk_values",),
)
def regression_metrics(book: Ledger) -> DataFrame:
    from duebook.operators.evaluate import regression_metrics as metrics

    return metrics(values_of(book), "actual_value", "predicted_value")
