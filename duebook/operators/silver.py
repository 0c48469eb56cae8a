"""Cleaned customers, payments per invoice and enriched invoices."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.sources.ledger import OVERDUE, PAID


def newest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order`` and then by the remaining columns.

    An aggregate, so copies of one key are reduced before the shuffle; NULL keys are dropped.
    """
    rest = [c for c in df.columns if c != key]
    ranked = [*order, *[c for c in rest if c not in order]]
    best = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(F.struct(*ranked)).alias("best"))
    return best.select(key, *[F.col(f"best.{c}").alias(c) for c in rest])


def clean_customers(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Trimmed text and one row per customer."""
    trimmed = [c for c, t in df.dtypes if t == "string"]
    tidy = df.select(*[F.trim(F.col(c)).alias(c) if c in trimmed else F.col(c) for c in df.columns])
    return newest_per_key(tidy, "customer_id", order)


def payments_by_invoice(payments: DataFrame) -> DataFrame:
    """Total, count, last date and the method of the earliest payment (ties by line, part, supplier)."""
    first_key = F.struct("payment_date", "line_no", "part_id", "supplier_id")
    return payments.groupBy("invoice_id").agg(
        F.sum("amount").cast("decimal(18,4)").alias("paid_total"),
        F.count(F.lit(1)).alias("n_payments"),
        F.min_by("method", first_key).alias("method"),
        F.max("payment_date").alias("last_payment"),
    )


def days_late(status: Column, due: Column, settled: Column) -> Column:
    return F.when(status == OVERDUE, F.greatest(F.datediff(settled, due), F.lit(1))).otherwise(0).cast("int")


def enrich_invoices(
    invoices: DataFrame, payments: DataFrame, as_of: dt.date, method: bool = True, late: bool = True
) -> DataFrame:
    """Invoices with what was paid on them; payments are summed first, so invoices never multiply.

    ``method`` and ``late`` leave out columns that a caller does not read, and with them their aggregates.
    """
    paid_flag = (F.col("status") == PAID).cast("int")
    paid = payments_by_invoice(payments)
    extra = ["paid_total"] + (["method"] if method else []) + (["last_payment"] if late else [])
    joined = (
        invoices.filter(F.col("amount") >= 0)
        .withColumnRenamed("amount", "total_amount")
        .join(paid.select("invoice_id", *extra), "invoice_id", "left")
        .withColumn("paid_total", F.coalesce("paid_total", F.lit(0).cast("decimal(18,4)")))
        .withColumn("paid_flag", paid_flag)
        .withColumn(
            "open_amount",
            F.when(F.col("status") == PAID, F.lit(0)).otherwise(F.col("total_amount") - F.col("paid_total")).cast(
                "decimal(18,4)"
            ),
        )
    )
    if late:
        settled = F.coalesce("last_payment", F.lit(as_of))
        joined = joined.withColumn("days_late", days_late(F.col("status"), F.col("due_date"), settled))
        joined = joined.drop("last_payment")
    return joined
