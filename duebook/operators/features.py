"""Customer features: trailing sums, counts by status, rates, recency score and R/F/M quintiles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.functions.bands import first_below, first_reached
from duebook.operators.ordering import ntiles
from duebook.session import stage
from duebook.sources.ledger import OVERDUE, PAID, PENDING

# Trailing windows, score bounds and category bounds.
TRAILING_DAYS = (90, 180, 365)
RECENCY_SCORES = ((30, 5), (60, 4), (90, 3), (180, 2))
CATEGORIES = ((4, "Premium"), (3, "Regular"))
LOWEST_CATEGORY = "At risk"
#: Freshness of a customer without invoices: below that of any date.
NEVER = -1e9

NUMERIC_FEATURES = [
    *[f"billed_{d}d" for d in TRAILING_DAYS],
    "n_invoices",
    "n_paid",
    "n_pending",
    "n_overdue",
    "avg_amount",
    "sd_amount",
    "min_amount",
    "max_amount",
    "pay_rate",
    "overdue_rate",
]


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole) * 100, digits)


def invoice_features(invoices: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per customer with invoices issued up to ``as_of``; recency comes from the same aggregate."""
    amount, status = F.col("total_amount"), F.col("status")
    age = F.datediff(F.lit(as_of), F.col("issue_date"))
    known = invoices.filter(F.col("issue_date") <= F.lit(as_of))

    def count_of(value: str) -> Column:
        return F.sum(F.when(status == value, 1).otherwise(0)).alias

    zero = F.lit(0).cast("decimal(18,2)")
    grouped = known.groupBy("customer_id").agg(
        *[F.sum(F.when(age <= d, amount).otherwise(zero)).cast("double").alias(f"billed_{d}d") for d in TRAILING_DAYS],
        F.count(F.lit(1)).alias("n_invoices"),
        count_of(PAID)("n_paid"),
        count_of(PENDING)("n_pending"),
        count_of(OVERDUE)("n_overdue"),
        F.sum(amount).cast("double").alias("sum_amount"),
        F.round(F.stddev(amount.cast("double")), 4).alias("sd_amount"),
        F.min(amount).cast("double").alias("min_amount"),
        F.max(amount).cast("double").alias("max_amount"),
        F.datediff(F.lit(as_of), F.max("issue_date")).alias("recency_days"),
    )
    return (
        grouped.withColumn("avg_amount", F.col("sum_amount") / F.col("n_invoices"))
        .withColumn("pay_rate", percent(F.col("n_paid"), F.col("n_invoices")))
        .withColumn("overdue_rate", percent(F.col("n_overdue"), F.col("n_invoices")))
        .drop("sum_amount")
    )


def customer_features(customers: DataFrame, invoices: DataFrame, as_of: dt.date) -> DataFrame:
    """Every customer; features of customers without invoices are 0 and their recency NULL."""
    joined = customers.join(invoice_features(invoices, as_of), "customer_id", "left")
    return joined.fillna(0, subset=NUMERIC_FEATURES).select(*customers.columns, *NUMERIC_FEATURES, "recency_days")


def recency(invoices: DataFrame, as_of: dt.date) -> DataFrame:
    """Days since each customer's newest invoice."""
    newest = invoices.groupBy("customer_id").agg(F.max("issue_date").alias("newest"))
    return newest.select("customer_id", F.datediff(F.lit(as_of), "newest").alias("recency_days"))


def add_recency_score(df: DataFrame) -> DataFrame:
    scored = df.withColumn("recency_score", first_below(F.col("recency_days"), RECENCY_SCORES, 1))
    return scored.withColumn("category", first_reached(F.col("recency_score"), CATEGORIES, LOWEST_CATEGORY))


def rfm_quintiles(features: DataFrame) -> DataFrame:
    """Quintiles of recency (recent = 5), frequency and money, each 1-5, and their three-digit code.

    Customers without invoices rank last in recency. Ties are ordered by customer.
    """
    base = stage(
        features.select(
            "customer_id",
            F.coalesce(-F.col("recency_days").cast("double"), F.lit(NEVER)).alias("freshness"),
            F.col("n_invoices").cast("double").alias("frequency"),
            F.col("billed_365d").alias("monetary"),
        )
    )
    scored = ntiles(base, {"r_quintile": "freshness", "f_quintile": "frequency", "m_quintile": "monetary"}, "customer_id", 5)
    code = F.col("r_quintile") * 100 + F.col("f_quintile") * 10 + F.col("m_quintile")
    return scored.select("customer_id", "r_quintile", "f_quintile", "m_quintile", code.alias("rfm_code"))


def load_sample(df: DataFrame, key: str, percent_kept: int) -> DataFrame:
    """A sample that depends on the key alone, so it is the same in every run and layout."""
    from duebook.functions.keys import hash_bucket

    return df.filter(hash_bucket(F.col(key), 100) < percent_kept)
