"""Value at risk, collections ranking and money indicators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.functions.bands import first_reached, right_closed
from duebook.operators.features import add_recency_score, percent
from duebook.operators.ordering import number_rows
from duebook.operators.scorecard import add_score, overdue_label, scoring_features
from duebook.session import stage
from duebook.sources.ledger import OVERDUE, PAID

# Fixed values. The published thresholds are for small accounts; SCALED suits invoices of the test tables' size.
PRIORITY_STEPS = ((20000, "Critical"), (5000, "High"), (1000, "Medium"))
PRIORITY_REST = "Low"
SCALED_PRIORITY_STEPS = ((400000, "Critical"), (150000, "High"), (40000, "Medium"))
MONEY_EDGES = (float("-inf"), 0, 5000, 20000, float("inf"))
SCALED_MONEY_EDGES = (float("-inf"), 0, 250000, 1000000, float("inf"))
MONEY_LABELS = ("None", "Low", "Medium", "High")
AGEING_EDGES = (0, 30, 60, 90, float("inf"))
AGEING_LABELS = ("0-30", "31-60", "61-90", "90+")
HIGH_PROBABILITY = 0.6


def customer_facts(invoices: DataFrame, as_of: dt.date) -> DataFrame:
    """Model inputs per customer from all invoices known at ``as_of``, with recency category and true label."""
    known = invoices.filter(F.col("issue_date") <= F.lit(as_of))
    overdue = F.count(F.when(F.col("status") == OVERDUE, 1))
    grouped = known.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n_known"),
        overdue.alias("n_overdue"),
        F.sum("amount").cast("double").alias("known_amount"),
        F.datediff(F.lit(as_of), F.max("issue_date")).alias("recency_days"),
    )
    return add_recency_score(grouped).select(
        "customer_id",
        "category",
        (F.col("n_overdue") / F.col("n_known")).alias("overdue_share"),
        (F.col("known_amount") / F.col("n_known")).alias("mean_amount"),
        "n_known",
        overdue_label(F.col("n_known"), F.col("n_overdue")).alias("label"),
    )


def score_customers(invoices: DataFrame, as_of: dt.date) -> DataFrame:
    """Default probability per customer by the fixed formula."""
    scored = add_score(customer_facts(invoices, as_of))
    return scored.select("customer_id", "category", F.col("score").alias("probability"), "predicted", "label")


def value_at_risk(invoices: DataFrame, as_of: dt.date, edges=MONEY_EDGES, labels=MONEY_LABELS) -> DataFrame:
    """Per customer: the target (90-day billing times overdue rate), the open amount as its estimate, and its band."""
    known = invoices.filter(F.col("issue_date") <= F.lit(as_of))
    recent = F.datediff(F.lit(as_of), F.col("issue_date")) <= 90
    zero = F.lit(0).cast("decimal(18,2)")
    grouped = known.groupBy("customer_id").agg(
        F.sum(F.when(recent, F.col("total_amount")).otherwise(zero)).cast("double").alias("billed_90d"),
        percent(F.count(F.when(F.col("status") == OVERDUE, 1)), F.count(F.lit(1))).alias("overdue_rate"),
        F.sum("open_amount").cast("double").alias("predicted_value"),
    )
    target = F.round(F.col("billed_90d") * F.col("overdue_rate") / 100, 6)
    return grouped.select(
        "customer_id",
        target.alias("actual_value"),
        "predicted_value",
        F.round(F.abs(target - F.col("predicted_value")), 6).alias("abs_error"),
        right_closed(F.col("predicted_value"), edges, labels).alias("money_band"),
    )


def prioritise(scores: DataFrame, values: DataFrame, steps=PRIORITY_STEPS, rest=PRIORITY_REST) -> DataFrame:
    """Probability times value at risk (never below zero) and its band."""
    joined = scores.join(values.select("customer_id", "predicted_value", "money_band"), "customer_id")
    at_risk = F.greatest(F.col("predicted_value"), F.lit(0.0))
    ranked = joined.withColumn("adjusted_value", at_risk)
    ranked = ranked.withColumn("priority_score", F.col("probability") * F.col("adjusted_value"))
    return ranked.withColumn("priority", first_reached(F.col("priority_score"), steps, rest))


def rank_collections(priorities: DataFrame) -> DataFrame:
    """Adds ``ranking``: 1 for the highest priority score, ties by customer."""
    return number_rows(stage(priorities), -F.col("priority_score"), F.col("customer_id"), "ranking")


def priority_rollup(priorities: DataFrame) -> DataFrame:
    value = F.sum(F.col("adjusted_value").cast("decimal(18,4)")).cast("double")
    return priorities.groupBy("priority").agg(F.count(F.lit(1)).alias("n_customers"), value.alias("value_at_risk"))


def ageing(invoices: DataFrame) -> DataFrame:
    """Overdue invoices by days late."""
    late = invoices.filter(F.col("status") == OVERDUE)
    band = right_closed(F.col("days_late"), AGEING_EDGES, AGEING_LABELS)
    return late.groupBy(band.alias("ageing")).agg(
        F.count(F.lit(1)).alias("n_invoices"),
        F.sum("total_amount").cast("double").alias("total_amount"),
        F.sum("open_amount").cast("double").alias("open_amount"),
    )


def money_indicators(invoices: DataFrame, priorities: DataFrame) -> DataFrame:
    """One row: overdue share of value, mean overdue ticket, delinquency rate, expected loss, risky customers."""
    amount = F.col("total_amount")
    late = F.col("status") == OVERDUE
    billed = F.sum(amount).cast("double")
    overdue = F.sum(F.when(late, amount)).cast("double")
    unpaid = F.sum(F.when(F.col("status") != PAID, F.greatest(F.col("open_amount"), F.lit(0)))).cast("double")
    money = invoices.agg(
        F.count(F.lit(1)).alias("n_invoices"),
        F.round(F.try_divide(overdue, billed) * 100, 4).alias("overdue_value_pct"),
        F.round(F.try_divide(overdue, F.count(F.when(late, 1))), 4).alias("mean_overdue_ticket"),
        F.round(F.try_divide(unpaid, billed) * 100, 4).alias("delinquency_pct"),
    )
    loss = priorities.agg(F.round(F.sum("priority_score"), 2)).scalar()
    risky = priorities.agg(F.count(F.when(F.col("probability") > HIGH_PROBABILITY, 1))).scalar()
    return money.select("*", loss.alias("expected_loss"), risky.alias("n_high_probability"))


def extreme_cases(scores: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` highest and lowest probabilities and the one closest to a half, tagged."""
    cols = ["customer_id", "probability", "predicted", "label"]

    def pick(kind: str, k: int, *order) -> DataFrame:
        return scores.select(*cols).orderBy(*order).limit(k).withColumn("case_kind", F.lit(kind))

    key = F.col("customer_id")
    return (
        pick("highest", n, F.desc("probability"), key)
        .unionByName(pick("lowest", n, F.asc("probability"), key))
        .unionByName(pick("borderline", 1, F.abs(F.col("probability") - 0.5), key))
    )
