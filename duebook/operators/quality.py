"""Integrity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.sources.ledger import OVERDUE, PAID, PENDING


def orphan_counts(customers: DataFrame, invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """Invoices without customer and payments without invoice.

    Child keys are counted before the anti join, so a parent with many children is one row there.
    """

    def orphans(child: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
        keys = child.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        lost = keys.join(parent.select(key), key, "left_anti")
        return lost.agg(F.lit(name).alias("check"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("bad_rows"))

    return orphans(invoices, customers, "customer_id", "invoice without customer").unionByName(
        orphans(payments, invoices, "invoice_id", "payment without invoice")
    )


def invoice_quality(invoices: DataFrame) -> DataFrame:
    """One row: counts of missing and repeated keys, negative amounts, unknown status, due before issue."""
    bad = {
        "null_keys": F.col("invoice_id").isNull() | F.col("customer_id").isNull(),
        "negative_amounts": F.col("amount") < 0,
        "unknown_status": ~F.coalesce(F.col("status").isin(PAID, PENDING, OVERDUE), F.lit(False)),
        "due_before_issue": F.col("due_date") < F.col("issue_date"),
    }
    per_key = invoices.groupBy("invoice_id").agg(
        F.count(F.lit(1)).alias("copies"), *[F.sum(c.cast("int")).alias(k) for k, c in bad.items()]
    )
    zero = F.lit(0)
    repeats = F.when(F.col("invoice_id").isNotNull(), F.col("copies") - 1).otherwise(zero)
    return per_key.agg(
        F.coalesce(F.sum("copies"), zero).alias("n_rows"),
        F.coalesce(F.sum(repeats), zero).alias("duplicate_keys"),
        *[F.coalesce(F.sum(k), zero).alias(k) for k in bad],
    )
