"""Documents, pages, statements and vector search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.functions.text import PAGE_RULES, WHITE_SPACE
from duebook.operators import documents as docs
from duebook.operators import textvectors, vectors
from duebook.operators.cellindex import CellIndex
from duebook.operators.silver import payments_by_invoice
from duebook.session import stage, workspace
from duebook.sources.ledger import Ledger

from .common_sql import view
from .foundation import as_double
from .indicators import scores_of
from .registry import query

view(
    "doc_words",
    f"SELECT *, list_filter(regexp_split_to_array(coalesce(text, ''), '{WHITE_SPACE}'), lambda w: w <> '') AS words FROM documents",
)


def page_sql(column: str) -> str:
    text = f"coalesce({column}, '')"
    for pattern, replacement in PAGE_RULES:
        old, new = pattern.replace("'", "''"), replacement.replace("'", "''")
        text = f"regexp_replace({text}, '{old}', '{new}', 'g')"
    return f"trim({text})".replace("'\n\n'", "chr(10) || chr(10)")


@query(
    "doc_metadata",
    """
SELECT doc_id, lang, source, 'documents/' || source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path,
  CAST(len(words) AS INTEGER) AS n_words, CAST(length(text) AS INTEGER) AS n_chars, round(strlen(text) / 1024.0E0, 4) AS size_kb,
  CASE WHEN coalesce(strlen(text), 0) > 0 THEN 'ready' ELSE 'empty' END AS status
FROM doc_words
""",
    ("doc_words",),
)
def doc_metadata(book: Ledger) -> DataFrame:
    return docs.metadata(book.table("documents"))


@query(
    "doc_type_counts",
    "SELECT source, lang, count(*) AS n_documents FROM documents GROUP BY source, lang ORDER BY n_documents DESC, source, lang",
)
def doc_type_counts(book: Ledger) -> DataFrame:
    counts = book.table("documents").groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n_documents"))
    return counts.orderBy(F.desc("n_documents"), "source", "lang")


@query(
    "doc_chunks",
    """
SELECT doc_id, lang, source, CAST(doc_id AS VARCHAR) || '_chunk_' || CAST(chunk_index AS VARCHAR) AS chunk_id, chunk_index,
  array_to_string(words[chunk_index * 231 + 1 : chunk_index * 231 + 256], ' ') AS chunk_text,
  CASE WHEN chunk_index = 0 THEN text END AS full_text
FROM (SELECT *, CAST(unnest(range(0, (len(words) + 230) // 231)) AS INTEGER) AS chunk_index FROM doc_words)
""",
    ("doc_words",),
)
def doc_chunks(book: Ledger) -> DataFrame:
    return docs.chunks(book.table("documents"))


@query(
    "doc_errors",
    """
SELECT doc_id, CASE WHEN coalesce(text, '') = '' THEN 'empty text' ELSE 'no chunks' END AS reason
FROM doc_words WHERE len(words) = 0
""",
    ("doc_words",),
)
def doc_errors(book: Ledger) -> DataFrame:
    return docs.chunk_errors(book.table("documents"))


@query(
    "tfidf_top_terms",
    """
SELECT doc_id, CAST(place AS INTEGER) AS place, term, tf, weight
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, term) AS place
  FROM (SELECT doc_id, term, tf, round(tf * ln((SELECT count(*) FROM documents) * 1.0E0 / df), 6) AS weight
    FROM (SELECT *, count(*) OVER (PARTITION BY term) AS df
      FROM (SELECT doc_id, term, count(*) AS tf
        FROM (SELECT doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '%s'), lambda w: w <> '')) AS term FROM documents)
        GROUP BY doc_id, term))))
WHERE place <= 5
"""
    % WHITE_SPACE,
)
def tfidf_top_terms(book: Ledger) -> DataFrame:
    return docs.top_terms(book.table("documents").select("doc_id", "text"))


@query(
    "page_text_extract",
    f"""
SELECT page_id, url, text, CAST(length(text) AS INTEGER) AS n_chars,
  CASE WHEN text = '' THEN 'empty text' ELSE 'ok' END AS status
FROM (SELECT page_id, url, {page_sql("html")} AS text FROM pages)
""",
)
def page_text_extract(book: Ledger) -> DataFrame:
    return docs.pages(book.table("pages"))


view(
    "rendered",
    """
SELECT i.invoice_id, i.customer_id, i.amount AS total_amount, p.paid_total AS documented_amount,
  concat_ws(chr(10), 'INVOICE No ' || CAST(i.invoice_id AS VARCHAR), 'Issuer: Receivables Ledger', 'Customer: ' || c.name,
    'Issue date: ' || CAST(i.issue_date AS VARCHAR), 'Amount: ' || CAST(i.amount AS VARCHAR),
    'Total paid: ' || CAST(CAST(p.paid_total AS DECIMAL(18,2)) AS VARCHAR), 'Due: ' || CAST(i.due_date AS VARCHAR)) AS text
FROM invoices i JOIN customers c ON c.customer_id = i.customer_id LEFT JOIN paid p ON p.invoice_id = i.invoice_id
""",
    "invoices",
    "customers",
    "paid",
)
REQUIRED_SQL = [f"CAST(NOT contains(text, '{f}') AS INTEGER)" for f in docs.REQUIRED_FIELDS]
view(
    "validated",
    f"""
SELECT *, CASE status WHEN 'APPROVED' THEN 'OK' WHEN 'APPROVED_WITH_REMARK' THEN 'LOW' ELSE 'HIGH' END AS severity,
  CASE WHEN status = 'APPROVED' THEN 'No issues' ELSE 'Amount differs by '
    || CAST(CAST(CAST(pct_diff AS DECIMAL(18,6)) AS DECIMAL(18,2)) AS VARCHAR) || '% or a required field is missing' END AS issues,
  CAST(status <> 'APPROVED' AS INTEGER) + missing_fields AS n_issues
FROM (SELECT *, CASE WHEN missing_fields = 0 AND pct_diff <= 2 THEN 'APPROVED'
    WHEN missing_fields = 0 AND pct_diff <= 5 THEN 'APPROVED_WITH_REMARK' ELSE 'REJECTED' END AS status
  FROM (SELECT invoice_id, customer_id, CAST(documented_amount AS DOUBLE) AS documented_amount,
      CAST(total_amount AS DOUBLE) AS invoice_amount,
      round(CAST(abs(coalesce(documented_amount, 0) - total_amount) AS DOUBLE) / CAST(total_amount AS DOUBLE) * 100, 6) AS pct_diff,
      {" + ".join(REQUIRED_SQL)} AS missing_fields FROM rendered))
""",
    "rendered",
)


def rendered_of(book: Ledger) -> DataFrame:
    paid = payments_by_invoice(book.payments()).select("invoice_id", F.col("paid_total").alias("documented_amount"))
    invoices = book.invoices().withColumnRenamed("amount", "total_amount").join(paid, "invoice_id", "left")
    return docs.render_invoices(invoices, book.customers())


@query("doc_render", "SELECT invoice_id, text FROM rendered", ("rendered",))
def doc_render(book: Ledger) -> DataFrame:
    return rendered_of(book).select("invoice_id", "text")


@query("doc_validation", "SELECT * FROM validated", ("validated",))
def doc_validation(book: Ledger) -> DataFrame:
    return docs.validate(rendered_of(book))


@query(
    "doc_validation_summary",
    """
SELECT status, count(*) AS n_documents, round(count(*) * 100.0E0 / sum(count(*)) OVER (), 4) AS pct_documents
FROM validated GROUP BY status
""",
    ("validated",),
)
def doc_validation_summary(book: Ledger) -> DataFrame:
    return docs.validation_summary(docs.validate(rendered_of(book)))


@query(
    "doc_required_fields",
    "\nUNION ALL\n".join(
        f"SELECT '{f}' AS field, count(*) AS n_documents, CAST(sum({sql}) AS BIGINT) AS n_missing FROM rendered"
        for f, sql in zip(docs.REQUIRED_FIELDS, REQUIRED_SQL)
    ),
    ("rendered",),
)
def doc_required_fields(book: Ledger) -> DataFrame:
    return docs.required_fields(rendered_of(book))


view(
    "movements",
    """
SELECT customer_id, issue_date AS day, 0 AS kind, invoice_id, 0 AS line_no, 0 AS part_id, 0 AS supplier_id,
  CAST(amount AS DECIMAL(18,4)) AS movement FROM invoices
UNION ALL
SELECT i.customer_id, p.payment_date, 1, p.invoice_id, p.line_no, p.part_id, p.supplier_id, -p.amount
FROM payments p JOIN invoices i ON i.invoice_id = p.invoice_id
""",
    "invoices",
    "payments",
)


def movements_of(book: Ledger) -> DataFrame:
    return docs.movements(book.invoices(), book.payments())


@query(
    "customer_statement",
    """
SELECT customer_id, day, kind, invoice_id, line_no, part_id, supplier_id, CAST(movement AS DOUBLE) AS movement,
  CAST(sum(movement) OVER (PARTITION BY customer_id ORDER BY day, kind, invoice_id, line_no, part_id, supplier_id
    ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS balance
FROM movements
""",
    ("movements",),
)
def customer_statement(book: Ledger) -> DataFrame:
    return as_double(docs.statement_lines(movements_of(book), book.invoices()))


@query(
    "statement_totals",
    """
SELECT *, CAST(credit_score > 600 AS INTEGER) AS approved FROM (
  SELECT t.customer_id, total_debits, total_credits, closing_balance, n_months,
    CAST(round((1 - s.probability) * 1000, 0) AS INTEGER) AS credit_score, round(total_credits * 0.8E0, 6) AS net_revenue,
    round(total_credits * 0.8E0 / n_months, 4) AS monthly_net_revenue
  FROM (SELECT customer_id, coalesce(CAST(sum(movement) FILTER (kind = 0) AS DOUBLE), 0) AS total_debits,
      coalesce(CAST(-sum(movement) FILTER (kind = 1) AS DOUBLE), 0) AS total_credits,
      CAST(sum(movement) AS DOUBLE) AS closing_balance,
      CAST((year(max(day)) - year(min(day))) * 12 + month(max(day)) - month(min(day)) + 1 AS INTEGER) AS n_months
    FROM movements GROUP BY customer_id) t
  JOIN customer_scores s ON s.customer_id = t.customer_id)
""",
    ("movements", "customer_scores"),
)
def statement_totals(book: Ledger) -> DataFrame:
    return docs.statement_totals(movements_of(book), scores_of(book))


def centroid_sql(source: str, by: str) -> str:
    return f"""
SELECT query_id, list(m ORDER BY i) AS vector
FROM (SELECT CAST({by} AS VARCHAR) AS query_id, i, round(avg(CAST(x AS DOUBLE)), 6) AS m
  FROM (SELECT {by}, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM {source}) GROUP BY ALL)
GROUP BY query_id
"""


def nearest_sql(queries: str, k: int, metric: str = "l2", on: str = "TRUE") -> str:
    c, q = "list_transform(c.embedding, lambda x: CAST(x AS DOUBLE))", "q.vector"
    if metric == "l2":
        d = f"pow(list_distance({c}, {q}), 2)"
    else:
        d = f"1.0E0 - list_cosine_similarity({c}, {q})"
    return f"""
SELECT query_id, CAST(place AS INTEGER) AS place, vec_id, distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS place
  FROM (SELECT q.query_id, c.vec_id, round({d}, 6) AS distance FROM {queries} q, embeddings c WHERE {on}))
WHERE place <= {k}
"""


view("label_centroids", centroid_sql("embeddings", "label"))
view(
    "labelled_vectors",
    """
SELECT e.embedding, CAST(e.label AS VARCHAR) || '-' || d.lang AS grp FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id
""",
)
view("group_centroids", centroid_sql("labelled_vectors", "grp"), "labelled_vectors")
view("same_label", nearest_sql("label_centroids", 5, "cosine", "CAST(c.label AS VARCHAR) = q.query_id"), "label_centroids")


def corpus_of(book: Ledger) -> DataFrame:
    return book.table("embeddings").select(
        "vec_id", F.col("embedding").alias("vector"), F.col("label").cast("string").alias("match")
    )


def label_queries(book: Ledger) -> DataFrame:
    return vectors.centroids(book.table("embeddings"), "label")


def group_queries(book: Ledger) -> DataFrame:
    languages = book.table("documents").select(F.col("doc_id").alias("vec_id"), "lang")
    group = F.concat_ws("-", F.col("label").cast("string"), "lang").alias("grp")
    return vectors.centroids(book.table("embeddings").join(languages, "vec_id").select("embedding", group), "grp")


def same_label_hits(book: Ledger) -> DataFrame:
    queries = label_queries(book).withColumn("match", F.col("query_id"))
    return vectors.nearest(queries, corpus_of(book), 5, "cosine", match=["match"])


@query(
    "knn_l2",
    f"SELECT *, round(1.0E0 / (1.0E0 + distance), 6) AS score FROM ({nearest_sql('label_centroids', 5)})",
    ("label_centroids",),
)
def knn_l2(book: Ledger) -> DataFrame:
    hits = vectors.nearest(label_queries(book), corpus_of(book), 5)
    return hits.withColumn("score", F.round(F.lit(1.0) / (F.lit(1.0) + F.col("distance")), 6))


@query("knn_cosine_filtered", "SELECT * FROM same_label", ("same_label",))
def knn_cosine_filtered(book: Ledger) -> DataFrame:
    return same_label_hits(book)


@query("knn_batch", nearest_sql("group_centroids", 3), ("group_centroids",))
def knn_batch(book: Ledger) -> DataFrame:
    return vectors.nearest(group_queries(book), corpus_of(book), 3)


@query(
    "rag_context",
    """
SELECT query_id, CAST(count(*) AS INTEGER) AS n_documents,
  string_agg(concat_ws(chr(10), concat_ws(' | ', '#' || CAST(place AS VARCHAR), 'document ' || CAST(vec_id AS VARCHAR), source, lang),
    coalesce(text, '(no text)')), chr(10) || '* * *' || chr(10) ORDER BY place) AS context
FROM same_label LEFT JOIN documents ON doc_id = vec_id GROUP BY query_id
""",
    ("same_label",),
)
def rag_context(book: Ledger) -> DataFrame:
    return vectors.context_blocks(same_label_hits(book), book.table("documents"))


@query(
    "knn_multi_filter",
    nearest_sql(
        "group_centroids", 3, "cosine", "q.query_id = CAST(c.label AS VARCHAR) || '-' || (SELECT lang FROM documents WHERE doc_id = c.vec_id)"
    ),
    ("group_centroids",),
)
def knn_multi_filter(book: Ledger) -> DataFrame:
    """Neighbours of the same label and language."""
    languages = book.table("documents").select(F.col("doc_id").alias("vec_id"), "lang")
    corpus = book.table("embeddings").join(languages, "vec_id").select("vec_id", F.col("embedding").alias("vector"), "label", "lang")
    parts = F.split("query_id", "-", 2)
    queries = group_queries(book).withColumns({"label": parts[0], "lang": parts[1]})
    return vectors.nearest(queries, corpus, 3, "cosine", match=["label", "lang"])


def bucket_sql(texts: str) -> str:
    """Bucket counts of (key, word) rows."""
    number = f"CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % {textvectors.BUCKETS}"
    return f"SELECT key, {number} AS bucket, count(*) AS tf FROM ({texts}) GROUP BY 1, 2"


view(
    "chunk_buckets",
    bucket_sql(
        f"SELECT doc_id * {textvectors.CHUNKS_PER_DOCUMENT} + i AS key, unnest(list_transform(words[i * 231 + 1 : i * 231 + 256], lambda w: lower(w))) AS word"
        " FROM (SELECT *, unnest(range(0, (len(words) + 230) // 231)) AS i FROM doc_words)"
    ),
    "doc_words",
)
view(
    "rarity",
    "SELECT bucket, ln(((SELECT count(DISTINCT key) FROM chunk_buckets) + 1) * 1.0E0 / (count(*) + 1)) AS idf FROM chunk_buckets GROUP BY bucket",
    "chunk_buckets",
)
UNIT_SQL = """
SELECT key, bucket, w / sqrt(sum(w * w) OVER (PARTITION BY key)) AS weight
FROM (SELECT key, b.bucket, tf * idf AS w FROM {} b JOIN rarity r ON r.bucket = b.bucket) WHERE w > 0
"""
view("chunk_units", UNIT_SQL.format("chunk_buckets"), "chunk_buckets", "rarity")
view(
    "question_buckets",
    bucket_sql(f"SELECT item_id AS key, unnest(list_filter(regexp_split_to_array(lower(text), '{WHITE_SPACE}'), lambda w: w <> '')) AS word FROM benchmark"),
)
view("question_units", UNIT_SQL.format("question_buckets"), "question_buckets", "rarity")


def counted_chunks(book: Ledger) -> DataFrame:
    chunks = textvectors.chunk_keys(docs.chunks(book.table("documents")))
    return stage(textvectors.hashed_counts(chunks, "chunk_text").drop("chunk_text"))


@query("chunk_vectors", "SELECT key AS vec_id, CAST(bucket AS INTEGER) AS bucket, round(weight, 6) AS weight FROM chunk_units WHERE round(weight, 6) > 0", ("chunk_units",))
def chunk_vectors(book: Ledger) -> DataFrame:
    """The vectors of all chunks, one row per bucket that counts."""
    counted = counted_chunks(book)
    found = textvectors.unit_vectors(counted, textvectors.fit_rarity(counted))
    rows = found.select("vec_id", F.posexplode("vector").alias("bucket", "weight"))
    return rows.withColumn("weight", F.round("weight", 6)).where("weight > 0")


@query(
    "text_search",
    """
SELECT query_id, CAST(place AS INTEGER) AS place, vec_id, distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS place
  FROM (SELECT CAST(q.item_id AS VARCHAR) AS query_id, c.key AS vec_id, round(greatest(1.0E0 - coalesce(dot, 0), 0), 6) AS distance
    FROM benchmark q CROSS JOIN (SELECT DISTINCT key FROM chunk_buckets) c
    LEFT JOIN (SELECT a.key AS item_id, b.key, sum(a.weight * b.weight) AS dot
      FROM question_units a JOIN chunk_units b ON a.bucket = b.bucket GROUP BY 1, 2) d ON d.item_id = q.item_id AND d.key = c.key))
WHERE place <= 3
""",
    ("chunk_buckets", "question_units", "chunk_units"),
)
def text_search(book: Ledger) -> DataFrame:
    """The three chunks nearest to each benchmark passage, by the cosine of their text vectors."""
    counted = counted_chunks(book)
    rarity = textvectors.fit_rarity(counted)
    asked = book.table("benchmark").select(F.col("item_id").cast("string").alias("query_id"), "text")
    questions = textvectors.unit_vectors(textvectors.hashed_counts(asked, "text").drop("text"), rarity)
    return vectors.nearest(questions, textvectors.unit_vectors(counted, rarity), 3, "cosine")


@query("knn_cells_exact", nearest_sql("group_centroids", 3), ("group_centroids",))
def knn_cells_exact(book: Ledger) -> DataFrame:
    """Search in a stored index of 32 cells: distance bounds say which rows may be left out."""
    index = CellIndex(book.spark, workspace(book.spark, "cells"))
    index.build(corpus_of(book), 32)
    return index.search(group_queries(book), 3)[0]


@query("knn_cell_recall")
def knn_cell_recall(book: Ledger) -> DataFrame:
    """Search in 3 of 32 cells: recall beside the share of rows compared."""
    corpus, queries = corpus_of(book).select("vec_id", "vector"), stage(group_queries(book))
    exact = vectors.nearest(queries, corpus, 3)
    return vectors.cell_recall(queries, corpus, exact, 3, cells=32, probes=3)


@query("knn_lsh_recall")
def knn_lsh_recall(book: Ledger) -> DataFrame:
    corpus, queries = corpus_of(book), stage(group_queries(book))
    exact = vectors.nearest(queries, corpus, 3)
    return vectors.lsh_recall(corpus, queries, exact, 3, 1.3)
