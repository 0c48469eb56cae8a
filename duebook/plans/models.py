"""Fitted models: segments, default classifier, value-at-risk regressor, tuning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.operators import evaluate, learning, search, segments
from duebook.operators.features import add_recency_score
from duebook.operators.scorecard import FEATURES
from duebook.session import stage
from duebook.sources.ledger import Ledger

from .common_sql import view
from .evaluation import point_in_time_of
from .foundation import features_of
from .indicators import values_of
from .registry import query

VALUE_FEATURES = ("n_invoices", "avg_amount", "sd_amount", "min_amount", "max_amount", "pay_rate", "recency_days")


def scaled_of(book: Ledger) -> DataFrame:
    rows = segments.impute_recency(add_recency_score(features_of(book)))
    return segments.scale(stage(rows.select("customer_id", *segments.SEGMENT_FEATURES)), segments.SEGMENT_FEATURES)


def cases_of(book: Ledger) -> DataFrame:
    """Point-in-time cases with the customer's categories and their split, staged for repeated passes."""
    labelled = point_in_time_of(book)
    split = evaluate.stratified_split(stage(labelled))
    return stage(split.join(book.customers().select("customer_id", *learning.CATEGORIES), "customer_id"))


def fitted(book: Ledger):
    cases = cases_of(book)
    return learning.fit_default_model(cases.filter(F.col("split") == "train"), FEATURES), cases


def value_cases(book: Ledger) -> DataFrame:
    keys = ["customer_id", *learning.CATEGORIES, *VALUE_FEATURES]
    targets = values_of(book).select("customer_id", "actual_value")
    rows = segments.impute_recency(features_of(book)).select(*keys).join(targets, "customer_id")
    return stage(rows.withColumn("label", F.lit(0)))


@query("kmeans_profiles")
def kmeans_profiles(book: Ledger) -> DataFrame:
    _, clustered = segments.fit(scaled_of(book))
    return segments.name_clusters(clustered).select(
        "customer_id", "cluster", "profile", "billed_90d", "pay_rate", "overdue_rate", "recency_score"
    )


@query("kmeans_quality")
def kmeans_quality(book: Ledger) -> DataFrame:
    model, clustered = segments.fit(scaled_of(book))
    quality = segments.silhouette(clustered)
    return clustered.agg(
        F.lit(segments.CLUSTERS).alias("k"),
        F.count(F.lit(1)).alias("n_customers"),
        F.lit(float(model.summary.trainingCost)).alias("cost"),
        F.lit(float(quality)).alias("silhouette"),
    )


@query("kmeans_profile_stats")
def kmeans_profile_stats(book: Ledger) -> DataFrame:
    _, clustered = segments.fit(scaled_of(book))
    return segments.name_clusters(clustered).groupBy("profile").agg(
        F.count(F.lit(1)).alias("n_customers"),
        *[F.round(F.avg(c), 2).alias(f"avg_{c}") for c in ("pay_rate", "overdue_rate", "billed_90d", "recency_score")],
    )


@query("gbt_default_scores")
def gbt_default_scores(book: Ledger) -> DataFrame:
    model, cases = fitted(book)
    return learning.score_default(model, cases).select("customer_id", "split", "label", "score", "predicted")


@query("gbt_default_metrics")
def gbt_default_metrics(book: Ledger) -> DataFrame:
    model, cases = fitted(book)
    scored = learning.score_default(model, cases).select("split", "label", "score", "predicted")
    by = ["split"]
    return (
        evaluate.classification_metrics(scored, by)
        .join(evaluate.auc(scored, by), by)
        .join(evaluate.ks(scored, by), by)
    )


@query("feature_importance")
def feature_importance(book: Ledger) -> DataFrame:
    model, cases = fitted(book)
    return learning.importances(model, cases)


@query("gbt_value_at_risk")
def gbt_value_at_risk(book: Ledger) -> DataFrame:
    rows = value_cases(book)
    placed = evaluate.stratified_split(rows)
    model = learning.fit_value_model(placed.filter(F.col("split") == "train"), VALUE_FEATURES, "actual_value")
    scored = model.transform(placed)
    return scored.select(
        "customer_id",
        "split",
        "actual_value",
        F.round("prediction", 2).alias("predicted_value"),
        F.round(F.abs(F.col("actual_value") - F.col("prediction")), 2).alias("abs_error"),
    )


view(
    "fold_rows",
    """
SELECT label, CAST((row_number() OVER (PARTITION BY label ORDER BY md5('fold' || CAST(customer_id AS VARCHAR)), customer_id) - 1)
  % 5 AS INTEGER) AS fold
FROM split_rows WHERE split = 'train'
""",
    "split_rows",
)


@query(
    "cv_folds",
    """
SELECT fold, n_pos, n_neg, CAST(all_pos - n_pos AS BIGINT) AS train_pos, CAST(all_neg - n_neg AS BIGINT) AS train_neg,
  round(coalesce(CAST(all_neg - n_neg AS DOUBLE) / nullif(all_pos - n_pos, 0), 1.0E0), 6) AS pos_weight
FROM (SELECT *, sum(n_pos) OVER () AS all_pos, sum(n_neg) OVER () AS all_neg
  FROM (SELECT fold, count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg FROM fold_rows GROUP BY fold))
""",
    ("fold_rows",),
)
def cv_folds(book: Ledger) -> DataFrame:
    """Sizes and class weights of the folds that the search uses."""
    cases = cases_of(book).filter(F.col("split") == "train")
    return search.fold_weights(stage(search.add_stratified_folds(cases, "customer_id")))


@query("cv_results")
def cv_results(book: Ledger) -> DataFrame:
    """Thirty settings in five stratified folds, each fold with a class weight of its own."""
    cases = cases_of(book).filter(F.col("split") == "train")
    return search.search(cases, FEATURES, learning.CATEGORIES, "customer_id")
