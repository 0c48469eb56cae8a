"""The point-in-time scorecard and its exact evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.operators import evaluate, scorecard
from duebook.session import stage
from duebook.sources.ledger import Ledger

from .common_sql import view
from .registry import query


def score_sql(weights: tuple[float, float, float, float], share="overdue_share", amount="mean_amount", n="n_known") -> str:
    a, b, c, d = (f"{w!r}E0" for w in weights)
    return (
        f"round(1.0E0 / (1.0E0 + exp(-({a} + {b} * {share} + {c} * ({amount} / 100000.0E0) + {d} * ({n} / 10.0E0)))), 6)"
    )


view(
    "point_in_time",
    """
SELECT customer_id, late * 1.0E0 / n_known AS overdue_share, amount / n_known AS mean_amount, n_known,
  CAST(later_late * 100 > later * 40 AS INTEGER) AS label
FROM (SELECT customer_id, count(*) FILTER (issue_date < as_of - 365) AS n_known,
    count(*) FILTER (issue_date < as_of - 365 AND status = 'OVERDUE') AS late,
    CAST(sum(amount) FILTER (issue_date < as_of - 365) AS DOUBLE) AS amount,
    count(*) FILTER (issue_date >= as_of - 365) AS later,
    count(*) FILTER (issue_date >= as_of - 365 AND status = 'OVERDUE') AS later_late
  FROM invoices, params GROUP BY customer_id)
WHERE n_known > 0 AND later > 0
""",
    "invoices",
    "params",
)
view(
    "scored",
    f"""
SELECT *, CAST(score >= 0.5 AS INTEGER) AS predicted
FROM (SELECT *, {score_sql(scorecard.VARIANTS["v1"])} AS score FROM point_in_time)
""",
    "point_in_time",
)
view(
    "variants",
    "SELECT *, CAST(score >= 0.5 AS INTEGER) AS predicted FROM ("
    + " UNION ALL ".join(
        f"SELECT *, '{v}' AS version, {score_sql(w)} AS score FROM point_in_time" for v, w in scorecard.VARIANTS.items()
    )
    + ")",
    "point_in_time",
)
view(
    "split_rows",
    """
SELECT * EXCLUDE (i, label_rows), CASE WHEN i * 10 <= label_rows * 8 THEN 'train' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(customer_id AS VARCHAR)), customer_id) AS i,
    count(*) OVER (PARTITION BY label) AS label_rows FROM scored)
""",
    "scored",
)


def metrics_sql(source: str, by: str = "") -> str:
    group = f"GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    return f"""
SELECT {lead}n, round((tp + tn) * 1.0E0 / n, 6) AS accuracy,
  round(coalesce(tp * 1.0E0 / nullif(tp + fp, 0), 0), 6) AS precision,
  round(coalesce(tp * 1.0E0 / nullif(tp + fn, 0), 0), 6) AS recall,
  round(f1_pos, 6) AS f1, round(((tp + fn) * f1_pos + (tn + fp) * f1_neg) / n, 6) AS f1_weighted
FROM (SELECT *, coalesce(2.0E0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1_pos,
    coalesce(2.0E0 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f1_neg
  FROM (SELECT {lead}count(*) AS n, count(*) FILTER (label = 1 AND predicted = 1) AS tp,
      count(*) FILTER (label = 0 AND predicted = 1) AS fp, count(*) FILTER (label = 1 AND predicted = 0) AS fn,
      count(*) FILTER (label = 0 AND predicted = 0) AS tn FROM {source} {group}))
"""


def ordered_sql(source: str, by: str = "") -> str:
    """Counts per score, up to it (ascending, inclusive) and in all."""
    lead = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""
SELECT *, sum(pos) OVER ({part} ORDER BY score) AS upto_pos, sum(neg) OVER ({part} ORDER BY score) AS upto_neg,
  sum(pos) OVER ({part}) AS all_pos, sum(neg) OVER ({part}) AS all_neg
FROM (SELECT {lead}score, sum(label) AS pos, sum(1 - label) AS neg FROM {source} GROUP BY {lead}score)
"""


AREA = "round(coalesce(CAST(sum(pos * (upto_neg - neg + neg / 2.0E0)) AS DOUBLE) / nullif(CAST(max(all_pos) AS DOUBLE) * CAST(max(all_neg) AS DOUBLE), 0), 0), 6)"
GAP = """round(max(abs(coalesce(CAST(upto_pos AS DOUBLE) / nullif(CAST(all_pos AS DOUBLE), 0), 0)
  - coalesce(CAST(upto_neg AS DOUBLE) / nullif(CAST(all_neg AS DOUBLE), 0), 0))), 6)"""
AVERAGE_PRECISION = """round(sum(CAST(pos AS DOUBLE) / CAST(all_pos AS DOUBLE) * (CAST(all_pos - upto_pos + pos AS DOUBLE)
  / CAST(all_pos - upto_pos + pos + all_neg - upto_neg + neg AS DOUBLE))), 6)"""

view("ordered_scores", ordered_sql("scored"), "scored")


def point_in_time_of(book: Ledger) -> DataFrame:
    return scorecard.point_in_time(book.invoices(), book.as_of)


def scored_of(book: Ledger) -> DataFrame:
    return scorecard.add_score(point_in_time_of(book))


def split_of(book: Ledger) -> DataFrame:
    return evaluate.stratified_split(scored_of(book))


@query("scorecard", "SELECT * FROM scored", ("scored",))
def scorecard_rows(book: Ledger) -> DataFrame:
    return scored_of(book)


@query("stratified_split", "SELECT customer_id, label, score, split FROM split_rows", ("split_rows",))
def stratified_split(book: Ledger) -> DataFrame:
    return split_of(book).select("customer_id", "label", "score", "split")


@query(
    "split_union_check",
    """
SELECT split, label, count(*) AS n, CAST(min(customer_id) AS BIGINT) AS first_customer,
  CAST(max(customer_id) AS BIGINT) AS last_customer
FROM (SELECT split, label, customer_id FROM split_rows UNION ALL SELECT 'both', label, customer_id FROM split_rows)
GROUP BY split, label
""",
    ("split_rows",),
)
def split_union_check(book: Ledger) -> DataFrame:
    parts = split_of(book).select("split", "label", "customer_id")
    both = parts.filter(F.col("split") == "train").unionByName(parts.filter(F.col("split") == "test"))
    return (
        both.select(F.inline(F.array(F.struct("split", "label", "customer_id"),
                                     F.struct(F.lit("both").alias("split"), "label", "customer_id"))))
        .groupBy("split", "label")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("customer_id").alias("first_customer"),
            F.max("customer_id").alias("last_customer"),
        )
    )


@query(
    "class_balance",
    """
SELECT split, count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg,
  round(count(*) FILTER (label = 0) * 1.0E0 / nullif(count(*) FILTER (label = 1), 0), 6) AS pos_weight
FROM split_rows GROUP BY split
""",
    ("split_rows",),
)
def class_balance(book: Ledger) -> DataFrame:
    return evaluate.class_balance(split_of(book), ["split"])


@query("classification_metrics", metrics_sql("scored"), ("scored",))
def classification_metrics(book: Ledger) -> DataFrame:
    return evaluate.classification_metrics(scored_of(book))


@query(
    "confusion_matrix",
    "SELECT label, predicted, count(*) AS n FROM scored GROUP BY label, predicted",
    ("scored",),
)
def confusion_matrix(book: Ledger) -> DataFrame:
    return evaluate.confusion_matrix(scored_of(book))


@query("auc_exact", f"SELECT {AREA} AS auc FROM ordered_scores", ("ordered_scores",))
def auc_exact(book: Ledger) -> DataFrame:
    return evaluate.auc(scored_of(book))


@query(
    "roc_points",
    """
SELECT score AS threshold, round(CAST(all_neg - upto_neg + neg AS DOUBLE) / CAST(all_neg AS DOUBLE), 6) AS false_positive_rate,
  round(CAST(all_pos - upto_pos + pos AS DOUBLE) / CAST(all_pos AS DOUBLE), 6) AS true_positive_rate
FROM ordered_scores
""",
    ("ordered_scores",),
)
def roc_points(book: Ledger) -> DataFrame:
    return evaluate.roc_points(scored_of(book))


@query(
    "pr_average_precision",
    f"SELECT {AVERAGE_PRECISION} AS average_precision, count(*) AS n_points FROM ordered_scores",
    ("ordered_scores",),
)
def pr_average_precision(book: Ledger) -> DataFrame:
    return evaluate.average_precision(scored_of(book))


@query(
    "ks_train_test",
    f"""
SELECT ks_train, ks_test, round(ks_train - ks_test, 6) AS ks_gap, CAST(ks_test > 0.7 AS INTEGER) AS suspect_leakage
FROM (SELECT max(ks) FILTER (split = 'train') AS ks_train, max(ks) FILTER (split = 'test') AS ks_test
  FROM (SELECT split, {GAP} AS ks FROM ({ordered_sql("split_rows", "split")}) GROUP BY split))
""",
    ("split_rows",),
)
def ks_train_test(book: Ledger) -> DataFrame:
    return evaluate.ks_train_test(split_of(book))


DECILES = """
SELECT CAST(row_number() OVER (ORDER BY low DESC) AS INTEGER) AS decile, n, positives,
  round(positives * 100.0E0 / n, 4) AS positive_pct
FROM (SELECT low, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives
  FROM (SELECT label, len(list_filter(list_distinct(edges), lambda e: e < score)) AS low
    FROM scored, (SELECT quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM scored))
  GROUP BY low)
"""
view("deciles", DECILES, "scored")


@query("decile_table", "SELECT * FROM deciles", ("deciles",))
def decile_table(book: Ledger) -> DataFrame:
    return evaluate.decile_table(stage(scored_of(book).select("label", "score")))


@query(
    "decile_inversions",
    """
SELECT count(*) AS n_deciles, CAST(sum(CASE WHEN before < positive_pct THEN 1 ELSE 0 END) AS BIGINT) AS inversions
FROM (SELECT *, lag(positive_pct) OVER (ORDER BY decile) AS before FROM deciles)
""",
    ("deciles",),
)
def decile_inversions(book: Ledger) -> DataFrame:
    return evaluate.decile_inversions(evaluate.decile_table(stage(scored_of(book).select("label", "score"))))


@query(
    "threshold_sweep",
    """
SELECT threshold, f1, CAST(row_number() OVER (ORDER BY f1 DESC, threshold) = 1 AS INTEGER) AS is_best
FROM (SELECT threshold, round(coalesce(2.0E0 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
  FROM (SELECT threshold, count(*) FILTER (label = 1 AND score >= threshold) AS tp,
      count(*) FILTER (label = 0 AND score >= threshold) AS fp, count(*) FILTER (label = 1 AND score < threshold) AS fn
    FROM scored, (SELECT CAST(h AS DOUBLE) / 100.0E0 AS threshold FROM range(30, 70) r(h)) GROUP BY threshold))
""",
    ("scored",),
)
def threshold_sweep(book: Ledger) -> DataFrame:
    return evaluate.threshold_sweep(scored_of(book))


@query(
    "score_summary",
    """
SELECT count(*) AS n, round(avg(score), 6) AS mean_score, round(quantile_cont(score, 0.5), 6) AS median_score,
  round(stddev_samp(score), 6) AS sd_score
FROM scored
""",
    ("scored",),
)
def score_summary(book: Ledger) -> DataFrame:
    return evaluate.score_summary(scored_of(book))


def permuted_sql() -> str:
    features = scorecard.FEATURES
    options = []
    for changed in ("none", *features):
        inputs = [f"d.{f}" if f == changed else f"r.{f}" for f in features]
        options.append(f"SELECT '{changed}' AS feature, r.label, {score_sql(scorecard.VARIANTS['v1'], *inputs)} AS score FROM r JOIN d ON d.place = r.place")
    return " UNION ALL ".join(options)


view(
    "r",
    "SELECT *, row_number() OVER (ORDER BY md5('r' || CAST(customer_id AS VARCHAR)), customer_id) AS place FROM point_in_time",
    "point_in_time",
)
view(
    "d",
    "SELECT *, row_number() OVER (ORDER BY md5('d' || CAST(customer_id AS VARCHAR)), customer_id) AS place FROM point_in_time",
    "point_in_time",
)
view("permuted", permuted_sql(), "r", "d")


@query(
    "permutation_importance",
    f"""
SELECT feature, base_auc, auc, round(base_auc - auc, 6) AS auc_drop
FROM (SELECT *, max(auc) FILTER (feature = 'none') OVER () AS base_auc
  FROM (SELECT feature, {AREA} AS auc FROM ({ordered_sql("permuted", "feature")}) GROUP BY feature))
WHERE feature <> 'none'
""",
    ("permuted",),
)
def permutation_importance(book: Ledger) -> DataFrame:
    weights = scorecard.VARIANTS[scorecard.DEFAULT_VARIANT]
    return evaluate.permutation_importance(
        stage(point_in_time_of(book)), scorecard.FEATURES, lambda *x: scorecard.logistic_score(weights, *x)
    )


@query(
    "model_comparison",
    f"""
SELECT version, n, accuracy, precision, recall, f1, f1_weighted, auc, ks, average_precision,
  CAST(row_number() OVER (ORDER BY auc DESC, version) AS INTEGER) AS place
FROM ({metrics_sql("variants", "version")}) m
JOIN (SELECT version, {AREA} AS auc, {GAP} AS ks, {AVERAGE_PRECISION} AS average_precision
  FROM ({ordered_sql("variants", "version")}) GROUP BY version) o USING (version)
""",
    ("variants",),
)
def model_comparison(book: Ledger) -> DataFrame:
    from pyspark.sql import Window

    rows = scorecard.score_variants(point_in_time_of(book))
    table = evaluate.score_report(rows, ["version"])
    names = ["version", "n", "accuracy", "precision", "recall", "f1", "f1_weighted", "auc", "ks", "average_precision"]
    # one row per version
    place = F.row_number().over(Window.orderBy(F.desc("auc"), "version"))
    return table.select(*names, place.alias("place"))
