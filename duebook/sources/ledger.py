"""Customers, invoices and payments as read from the order tables, and the as-of date.

Every job takes the as-of date as a parameter; the default is the newest issue date. No job looks at the clock.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import money, read_table

# Payment terms in days by order priority, and status names.
TERM_DAYS = {"1-URGENT": 30, "2-HIGH": 30, "3-MEDIUM": 60}
OTHER_TERM_DAYS = 90
PAID, PENDING, OVERDUE = "PAID", "PENDING", "OVERDUE"


@dataclass
class Ledger:
    """Entry point to the source tables in ``folder``; frames are lazy and read only the columns a job uses."""

    spark: SparkSession
    folder: str
    as_of_date: dt.date | None = None
    _frames: dict = field(default_factory=dict, repr=False)

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = read_table(self.spark, self.folder, name)
        return self._frames[name]

    @property
    def as_of(self) -> dt.date:
        """One aggregated row; a literal date lets scans prune and filters push down."""
        if self.as_of_date is None:
            newest = self.table("orders").agg(F.max("o_orderdate").cast("date").alias("d")).first()
            self.as_of_date = newest["d"]
        return self.as_of_date

    def customers(self) -> DataFrame:
        nation = self.table("nation").select("n_nationkey", F.col("n_name").alias("nation"))
        balance = F.col("c_acctbal")
        size = F.when(balance < 3000, "SMALL").when(balance < 7000, "MEDIUM").otherwise("LARGE")
        return (
            self.table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_name").alias("name"),
                F.col("c_mktsegment").alias("sector"),
                size.alias("size_band"),
                "nation",
            )
        )

    def invoices(self) -> DataFrame:
        issued = F.col("o_orderdate").cast("date")
        term = F.lit(OTHER_TERM_DAYS)
        for priority, days in TERM_DAYS.items():
            term = F.when(F.col("o_orderpriority") == priority, days).otherwise(term)
        status = (
            F.when(F.col("o_orderstatus") == "F", PAID).when(F.col("o_orderstatus") == "O", PENDING).otherwise(OVERDUE)
        )
        return self.table("orders").select(
            F.col("o_orderkey").alias("invoice_id"),
            F.col("o_custkey").alias("customer_id"),
            money("o_totalprice").alias("amount"),
            issued.alias("issue_date"),
            F.date_add(issued, term).alias("due_date"),
            status.alias("status"),
            F.date_format("o_orderdate", "yyyy-MM").alias("issue_month"),
        )

    def payments(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("invoice_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("part_id"),
            F.col("l_suppkey").alias("supplier_id"),
            money(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("amount"),
            F.col("l_shipdate").cast("date").alias("payment_date"),
            F.col("l_returnflag").alias("method"),
        )
