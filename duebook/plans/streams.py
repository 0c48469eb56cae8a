"""Streaming jobs over files made from the source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from duebook.operators import scorecard
from duebook.session import workspace
from duebook.sources.ledger import Ledger
from duebook.streaming import chunks, ingest, metrics, scoring

from .common_sql import view
from .evaluation import point_in_time_of
from .foundation import as_double
from .registry import query

INVOICE_DROP = T.StructType(
    [
        T.StructField("invoice_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("amount", T.DecimalType(18, 2)),
        T.StructField("issue_date", T.DateType()),
        T.StructField("due_date", T.DateType()),
        T.StructField("status", T.StringType()),
    ]
)
CUSTOMER_DROP = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("sector", T.StringType()),
        T.StructField("balance", T.DoubleType()),
    ]
)


@query(
    "stream_csv_ingest",
    "SELECT invoice_id, customer_id, CAST(amount AS DOUBLE) AS amount, issue_date, due_date, status FROM invoices",
    ("invoices",),
)
def stream_csv_ingest(book: Ledger) -> DataFrame:
    """Exports the invoices as CSV drops and ingests them; a second run finds nothing new."""
    root = workspace(book.spark, "csv")
    book.invoices().select(*INVOICE_DROP.names).write.option("header", True).csv(f"{root}/drops")
    for _ in range(2):
        stream = ingest.csv_stream(book.spark, f"{root}/drops", INVOICE_DROP)
        ingest.append_available(stream, f"{root}/bronze", f"{root}/checkpoint")
    return as_double(book.spark.read.parquet(f"{root}/bronze").drop(ingest.CORRUPT))


@query(
    "csv_rescue_split",
    """
SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS sector,
  CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance, CAST(c_acctbal < 0 AS INTEGER) AS rescued
FROM customer
""",
)
def csv_rescue_split(book: Ledger) -> DataFrame:
    """Negative balances arrive in accounting notation, e.g. ``(12.5)``; such lines are kept as text."""
    root = workspace(book.spark, "csv")
    balance = F.col("c_acctbal")
    written = F.when(balance < 0, F.concat(F.lit("("), (-balance).cast("string"), F.lit(")"))).otherwise(
        balance.cast("string")
    )
    lines = book.table("customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("sector"),
        written.alias("balance"),
    )
    lines.write.option("header", True).csv(f"{root}/drops")
    read = ingest.read_csv_drops(book.spark, f"{root}/drops", CUSTOMER_DROP)
    return read.select(*CUSTOMER_DROP.names, F.col(ingest.CORRUPT).isNotNull().cast("int").alias("rescued"))


@query(
    "stream_daily_metrics",
    """
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n_events,
  CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total_value, count(*) FILTER (event_type = 'error') AS n_errors
FROM events
GROUP BY 1, 2
""",
)
def stream_daily_metrics(book: Ledger) -> DataFrame:
    """Every day of the events, the open one included."""
    root = workspace(book.spark, "metrics")
    metrics.upsert_daily_metrics(metrics.event_stream(book.spark, book.folder), f"{root}/daily", f"{root}/checkpoint")
    return metrics.current_daily_metrics(book.spark, f"{root}/daily")


@query("stream_scoring", "SELECT customer_id, score, predicted FROM scored", ("scored",))
def stream_scoring(book: Ledger) -> DataFrame:
    root = workspace(book.spark, "scoring")
    requests = point_in_time_of(book).drop("label")
    requests.write.parquet(f"{root}/requests")
    scoring.score_requests(
        book.spark,
        f"{root}/requests",
        requests.schema,
        scorecard.add_score,
        f"{root}/scores",
        f"{root}/checkpoint",
    )
    return book.spark.read.parquet(f"{root}/scores").select("customer_id", "score", "predicted")


view(
    "revised_words",
    """
SELECT doc_id, 'Revised. ' || text AS text, 2 AS version, list_prepend('Revised.', words) AS words FROM doc_words
WHERE lang = 'de'
UNION ALL
SELECT doc_id, text, 1, words FROM doc_words WHERE lang NOT IN ('de', 'fr')
""",
    "doc_words",
)


@query(
    "stream_chunk_upsert",
    """
SELECT doc_id, version, CAST(doc_id AS VARCHAR) || '_chunk_' || CAST(chunk_index AS VARCHAR) AS chunk_id, chunk_index,
  array_to_string(words[chunk_index * 231 + 1 : chunk_index * 231 + 256], ' ') AS chunk_text
FROM (SELECT *, CAST(unnest(range(0, (len(words) + 230) // 231)) AS INTEGER) AS chunk_index FROM revised_words)
""",
    ("revised_words",),
)
def stream_chunk_upsert(book: Ledger) -> DataFrame:
    """All documents arrive, then a revision of the German ones; after a compaction the revision comes again, with a
    French version without text. The first versions must be gone, repeats appear once, the emptied have no chunks."""
    root = workspace(book.spark, "chunks")
    first = book.table("documents").select("doc_id", "text", "lang", "source", F.lit(1).alias("version"))
    revised = first.filter(F.col("lang") == "de").withColumns(
        {"text": F.concat(F.lit("Revised. "), "text"), "version": F.lit(2)}
    )
    emptied = first.filter(F.col("lang") == "fr").withColumns({"text": F.lit(""), "version": F.lit(2)})

    def send(part: DataFrame) -> None:
        part.write.mode("append").parquet(f"{root}/feed")
        chunks.sync_chunks(book.spark, f"{root}/feed", first.schema, f"{root}/chunks", f"{root}/checkpoint")

    send(first)
    send(revised)
    chunks.compact(book.spark, f"{root}/chunks")
    send(revised.unionByName(emptied))
    current = chunks.current_chunks(book.spark, f"{root}/chunks")
    return current.select("doc_id", "version", "chunk_id", "chunk_index", "chunk_text")
