"""Cleaned tables, customer features and integrity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.functions.keys import hash_bucket
from duebook.operators import features as feats
from duebook.operators import masking, quality
from duebook.operators import silver as clean
from duebook.session import workspace
from duebook.sources import sinks
from duebook.sources.ledger import Ledger
from duebook.sources.widening import WideningTable

from .registry import query


def silver_of(book: Ledger, **columns: bool) -> DataFrame:
    return clean.enrich_invoices(book.invoices(), book.payments(), book.as_of, **columns)


def features_of(book: Ledger) -> DataFrame:
    """Amounts and status come from invoices alone, so the features do not read payments."""
    known = book.invoices().filter(F.col("amount") >= 0).withColumnRenamed("amount", "total_amount")
    return feats.customer_features(book.customers(), known, book.as_of)


def as_double(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the type of the source tables."""
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])


@query(
    "payments_by_invoice",
    """
SELECT invoice_id, CAST(paid_total AS DOUBLE) AS paid_total, n_payments, method, last_payment FROM paid
""",
    ("paid",),
)
def payments_by_invoice(book: Ledger) -> DataFrame:
    return as_double(clean.payments_by_invoice(book.payments()))


@query(
    "silver_invoices",
    """
SELECT invoice_id, customer_id, CAST(total_amount AS DOUBLE) AS total_amount, issue_date, due_date, status, issue_month,
  CAST(paid_total AS DOUBLE) AS paid_total, method, paid_flag, CAST(open_amount AS DOUBLE) AS open_amount, days_late
FROM silver
""",
    ("silver",),
)
def silver_invoices(book: Ledger) -> DataFrame:
    return as_double(silver_of(book))


RESENT = """
SELECT customer_id, trim(name) AS name, trim(sector) AS sector, trim(size_band) AS size_band, trim(nation) AS nation,
  load_no
FROM (
  SELECT customer_id, name, sector, size_band, nation, 1 AS load_no FROM customers
  UNION ALL
  SELECT customer_id, '  ' || name || ' ', sector || ' ', size_band, nation, 2 FROM customers
)
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY load_no DESC) = 1
"""


def customers_sent_twice(book: Ledger) -> DataFrame:
    """The first load has no load number; a second load of the whole table has one, and padded text."""
    first = book.customers()
    again = first.withColumns(
        {
            "name": F.concat(F.lit("  "), "name", F.lit(" ")),
            "sector": F.concat("sector", F.lit(" ")),
            "load_no": F.lit(2),
        }
    )
    return first.unionByName(again, allowMissingColumns=True).fillna(1, subset=["load_no"])


@query("silver_customers", RESENT, ("customers",))
def silver_customers(book: Ledger) -> DataFrame:
    return clean.clean_customers(customers_sent_twice(book), ["load_no"])


@query(
    "bronze_union_evolved",
    """
SELECT load_no, count(*) AS n_rows, count(DISTINCT customer_id) AS n_customers,
  CAST(sum(length(name)) AS BIGINT) AS name_chars
FROM (
  SELECT customer_id, name, 1 AS load_no FROM customers
  UNION ALL
  SELECT customer_id, '  ' || name || ' ', 2 FROM customers
) GROUP BY load_no
""",
    ("customers",),
)
def bronze_union_evolved(book: Ledger) -> DataFrame:
    # customers per load first, so that no distinct aggregate is needed
    per_customer = (
        customers_sent_twice(book)
        .groupBy("load_no", "customer_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("name")).alias("chars"))
    )
    return per_customer.groupBy("load_no").agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_customers"),
        F.sum("chars").alias("name_chars"),
    )


@query("customer_features", "SELECT * FROM features", ("features",))
def customer_features(book: Ledger) -> DataFrame:
    return features_of(book)


@query(
    "rfm_recency",
    "SELECT customer_id, name, size_band, recency_days, recency_score, category, billed_90d, pay_rate FROM rfm",
    ("rfm",),
)
def rfm_recency(book: Ledger) -> DataFrame:
    scored = feats.add_recency_score(features_of(book))
    return scored.select(
        "customer_id", "name", "size_band", "recency_days", "recency_score", "category", "billed_90d", "pay_rate"
    )


@query(
    "rfm_quintiles",
    """
SELECT *, r_quintile * 100 + f_quintile * 10 + m_quintile AS rfm_code FROM (
  SELECT customer_id,
    CAST(ntile(5) OVER (ORDER BY -recency_days NULLS FIRST, customer_id) AS INTEGER) AS r_quintile,
    CAST(ntile(5) OVER (ORDER BY n_invoices, customer_id) AS INTEGER) AS f_quintile,
    CAST(ntile(5) OVER (ORDER BY billed_365d, customer_id) AS INTEGER) AS m_quintile
  FROM features)
""",
    ("features",),
)
def rfm_quintiles(book: Ledger) -> DataFrame:
    return feats.rfm_quintiles(features_of(book))


@query(
    "profile_distribution",
    "SELECT category, count(*) AS n_customers FROM rfm GROUP BY category ORDER BY n_customers DESC, category",
    ("rfm",),
)
def profile_distribution(book: Ledger) -> DataFrame:
    scored = feats.add_recency_score(features_of(book).select("customer_id", "recency_days"))
    counts = scored.groupBy("category").agg(F.count(F.lit(1)).alias("n_customers"))
    return counts.orderBy(F.desc("n_customers"), "category")


@query(
    "profile_stats",
    """
SELECT category, round(avg(pay_rate), 4) AS avg_pay_rate, round(avg(overdue_rate), 4) AS avg_overdue_rate,
  round(CAST(sum(CAST(billed_90d AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS avg_billed_90d,
  round(avg(recency_score), 4) AS avg_recency_score
FROM rfm GROUP BY category
""",
    ("rfm",),
)
def profile_stats(book: Ledger) -> DataFrame:
    scored = feats.add_recency_score(features_of(book))
    billed = F.sum(F.col("billed_90d").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))
    return scored.groupBy("category").agg(
        F.round(F.avg("pay_rate"), 4).alias("avg_pay_rate"),
        F.round(F.avg("overdue_rate"), 4).alias("avg_overdue_rate"),
        F.round(billed, 4).alias("avg_billed_90d"),
        F.round(F.avg("recency_score"), 4).alias("avg_recency_score"),
    )


@query(
    "status_share",
    """
SELECT status, count(*) AS n_invoices, CAST(sum(amount) AS DOUBLE) AS total_amount,
  round(100.0E0 * count(*) / sum(count(*)) OVER (), 2) AS pct_invoices
FROM invoices GROUP BY status
""",
    ("invoices",),
)
def status_share(book: Ledger) -> DataFrame:
    counts = (
        book.invoices()
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("n_invoices"), F.sum("amount").cast("double").alias("total_amount"))
    )
    # one row per status
    whole = counts.agg(F.sum("n_invoices")).scalar()
    return counts.withColumn("pct_invoices", F.round(F.lit(100.0) * F.col("n_invoices") / whole, 2))


@query(
    "orphan_checks",
    """
SELECT 'invoice without customer' AS "check", count(*) AS bad_rows FROM invoices
WHERE customer_id NOT IN (SELECT customer_id FROM customers)
UNION ALL
SELECT 'payment without invoice', count(*) FROM payments WHERE invoice_id NOT IN (SELECT invoice_id FROM invoices)
""",
    ("customers", "invoices", "payments"),
)
def orphan_checks(book: Ledger) -> DataFrame:
    customers = book.table("customer").select(F.col("c_custkey").alias("customer_id"))
    return quality.orphan_counts(customers, book.invoices(), book.payments())


@query(
    "quality_checks",
    """
SELECT count(*) AS n_rows, count(invoice_id) - count(DISTINCT invoice_id) AS duplicate_keys,
  count(*) FILTER (invoice_id IS NULL OR customer_id IS NULL) AS null_keys,
  count(*) FILTER (amount < 0) AS negative_amounts,
  count(*) FILTER (status NOT IN ('PAID', 'PENDING', 'OVERDUE')) AS unknown_status,
  count(*) FILTER (due_date < issue_date) AS due_before_issue
FROM invoices
""",
    ("invoices",),
)
def quality_checks(book: Ledger) -> DataFrame:
    return quality.invoice_quality(book.invoices())


TABLES = ("customer", "orders", "lineitem", "nation", "region", "supplier", "part", "events", "documents", "labels",
          "embeddings", "pages", "benchmark", "conversations")


@query(
    "table_health",
    "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, CASE WHEN count(*) > 0 THEN 'OK' ELSE 'EMPTY' END AS status FROM {t}"
        for t in TABLES
    ),
)
def table_health(book: Ledger) -> DataFrame:
    """Row counts; the newest file time is ``sinks.freshness`` (it is not a function of the rows)."""
    parts = [sinks.health(book.table(t), t) for t in TABLES]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@query(
    "partitioned_invoice_month",
    """
SELECT issue_month, count(*) AS n_invoices, CAST(sum(amount) AS DOUBLE) AS total_amount
FROM invoices GROUP BY issue_month
""",
    ("invoices",),
)
def partitioned_invoice_month(book: Ledger) -> DataFrame:
    """Writes the fact by issue month and reads every month back."""
    path = workspace(book.spark, "invoices-by-month")
    sinks.overwrite_partitions(book.invoices(), path, "issue_month")
    months = book.spark.read.schema(sinks.written_schema(book.invoices(), "issue_month")).parquet(path)
    return months.groupBy("issue_month").agg(
        F.count(F.lit(1)).alias("n_invoices"), F.sum("amount").cast("double").alias("total_amount")
    )


@query(
    "compact_cluster",
    """
SELECT invoice_id, customer_id, CAST(amount AS DOUBLE) AS amount, issue_date, due_date, status, issue_month FROM invoices
""",
    ("invoices",),
)
def compact_cluster(book: Ledger) -> DataFrame:
    path = workspace(book.spark, "invoices-clustered")
    sinks.write_clustered(book.invoices(), path, ["customer_id", "due_date", "invoice_id"])
    return as_double(book.spark.read.parquet(path))


@query(
    "hash_sample",
    """
SELECT customer_id, name FROM customers
WHERE CAST('0x' || substr(md5(CAST(customer_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 10
""",
    ("customers",),
)
def hash_sample(book: Ledger) -> DataFrame:
    return feats.load_sample(book.customers(), "customer_id", 10).select("customer_id", "name")


@query(
    "masked_customers",
    """
SELECT customer_id, regexp_replace(name, '[0-9]', '*', 'g') AS name, sector,
  CAST('0x' || substr(md5(CAST(customer_id AS VARCHAR)), 1, 8) AS BIGINT) % 16 AS tenant
FROM customers
""",
    ("customers",),
)
def masked_customers(book: Ledger) -> DataFrame:
    """What a reader without the full-data role sees: digits of the identifying name are masked."""
    return book.customers().select(
        "customer_id",
        F.regexp_replace("name", "[0-9]", "*").alias("name"),
        "sector",
        hash_bucket(F.col("customer_id"), 16).alias("tenant"),
    )


@query(
    "masked_by_role",
    """
SELECT 'analyst' AS role, customer_id, regexp_replace(name, '[0-9]', '*', 'g') AS name, sector, size_band,
  CAST(NULL AS VARCHAR) AS nation
FROM customers
UNION ALL
SELECT 'collections', customer_id, name, sector, size_band, nation FROM customers
UNION ALL
SELECT 'partner', customer_id, md5(name), NULL, size_band, NULL FROM customers
""",
    ("customers",),
)
def masked_by_role(book: Ledger) -> DataFrame:
    """The customers as three roles see them, by one policy table."""
    rules = [("analyst", "name", "digits"), ("analyst", "sector", "show"), ("analyst", "size_band", "show")]
    rules += [("collections", c, "show") for c in ("name", "sector", "size_band", "nation")]
    rules += [("partner", "name", "digest"), ("partner", "size_band", "show"), ("partner", "sector", "hide")]
    policy = book.spark.createDataFrame(rules, masking.POLICY)
    roles = F.explode(F.array(*map(F.lit, ("analyst", "collections", "partner")))).alias("role")
    rows = book.customers().select(roles, "customer_id", "name", "sector", "size_band", "nation")
    return masking.masked(rows, policy, ["customer_id"])


@query(
    "bronze_widened",
    """
SELECT customer_id, name, sector, CAST(NULL AS INTEGER) AS load_no, CAST(NULL AS VARCHAR) AS channel, '1' AS load_id
FROM customers
UNION ALL
SELECT customer_id, '  ' || name || ' ', NULL, 2, 'export', '2' FROM customers WHERE nation IS NOT NULL
""",
    ("customers",),
)
def bronze_widened(book: Ledger) -> DataFrame:
    """A second load brings two more columns and lacks one; it is sent twice and stands once."""
    table = WideningTable(book.spark, workspace(book.spark, "widened"))
    table.append("1", book.customers().select("customer_id", "name", "sector"))
    padded = F.concat(F.lit("  "), "name", F.lit(" ")).alias("name")
    second = book.customers().where(F.col("nation").isNotNull())
    for _ in range(2):
        table.append("2", second.select("customer_id", padded, F.lit(2).alias("load_no"), F.lit("export").alias("channel")))
    return table.read()


@query(
    "gold_replaced",
    """
SELECT customer_id, count(*) AS n_invoices, max(due_date) AS last_due FROM invoices GROUP BY customer_id
""",
    ("invoices",),
)
def gold_replaced(book: Ledger) -> DataFrame:
    """A full overwrite replaces the columns of the table with the rows."""
    path = workspace(book.spark, "gold")
    by_customer = book.invoices().groupBy("customer_id")
    for columns in ([F.sum("amount").alias("total_amount")], [F.count(F.lit(1)).alias("n_invoices"), F.max("due_date").alias("last_due")]):
        sinks.overwrite(by_customer.agg(*columns), path)
    return book.spark.read.parquet(path)
