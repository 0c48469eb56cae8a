"""Documents: metadata, chunks, rendered invoices, validation against payments, statements and term weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duebook.functions.text import missing_count, page_text, word_windows, words
from duebook.operators.ordering import TIE_SLOTS, add_slots, cut_points, running_totals
from duebook.session import stage_files

# Chunk sizes, validation tolerances in percent, required fields, statement rates.
CHUNK_WORDS, CHUNK_OVERLAP = 256, 25
APPROVE_PCT, REMARK_PCT = 2, 5
REQUIRED_FIELDS = ("INVOICE No", "Issuer:", "Customer:", "Total paid:")
ISSUER = "Receivables Ledger"
SEVERITY = {"APPROVED": "OK", "APPROVED_WITH_REMARK": "LOW", "REJECTED": "HIGH"}
NET_SHARE = 0.8
APPROVAL_SCORE = 600
#: A term with more than one in so many rows of term counts is common; no more terms than this can be.
COMMON_SHARE = 100_000


def metadata(documents: DataFrame) -> DataFrame:
    size = F.octet_length("text")
    return documents.select(
        "doc_id",
        "lang",
        "source",
        F.concat_ws("/", F.lit("documents"), "source", F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias(
            "path"
        ),
        F.size(words(F.col("text"))).alias("n_words"),
        F.char_length("text").alias("n_chars"),
        F.round(size / 1024.0, 4).alias("size_kb"),
        F.when(F.coalesce(size, F.lit(0)) > 0, "ready").otherwise("empty").alias("status"),
    )


def chunks(documents: DataFrame, size: int = CHUNK_WORDS, overlap: int = CHUNK_OVERLAP, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per word window, with the ``carry`` columns; the first chunk of a document also has the whole text."""
    windows = word_windows(F.col("tokens"), size, overlap)
    # the text is attached inside the array, so that exploding does not copy it once per chunk
    parts = F.transform(
        windows,
        lambda chunk, i: F.struct(
            F.concat(F.col("doc_id").cast("string"), F.lit("_chunk_"), i.cast("string")).alias("chunk_id"),
            i.alias("chunk_index"),
            chunk.alias("chunk_text"),
            F.when(i == 0, F.col("text")).alias("full_text"),
        ),
    )
    # the generator reads the finished ``tokens`` column; projecting in between would split the text several times
    split = documents.withColumn("tokens", words(F.col("text")))
    return split.select("doc_id", "lang", "source", *carry, F.inline(parts))


def chunk_errors(documents: DataFrame) -> DataFrame:
    """The documents that give no chunk, and why."""
    text = F.coalesce("text", F.lit(""))
    reason = F.when(text == "", "empty text").when(F.size(words(text)) == 0, "no chunks")
    return documents.select("doc_id", reason.alias("reason")).filter(F.col("reason").isNotNull())


def pages(table: DataFrame) -> DataFrame:
    text = page_text(F.col("html"))
    return table.select("page_id", "url", text.alias("text")).select(
        "*",
        F.char_length("text").alias("n_chars"),
        F.when(F.col("text") == "", "empty text").otherwise("ok").alias("status"),
    )


def render_invoices(invoices: DataFrame, customers: DataFrame) -> DataFrame:
    """One text per invoice; the payment lines are left out when nothing was paid."""
    named = invoices.join(customers.select("customer_id", "name"), "customer_id")
    amount = F.col("total_amount").cast("decimal(18,2)").cast("string")
    paid = F.col("documented_amount").cast("decimal(18,2)").cast("string")
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("INVOICE No "), F.col("invoice_id").cast("string")),
        F.lit(f"Issuer: {ISSUER}"),
        F.concat(F.lit("Customer: "), "name"),
        F.concat(F.lit("Issue date: "), F.col("issue_date").cast("string")),
        F.concat(F.lit("Amount: "), amount),
        F.concat(F.lit("Total paid: "), paid),
        F.concat(F.lit("Due: "), F.col("due_date").cast("string")),
    )
    return named.select("invoice_id", "customer_id", "total_amount", "documented_amount", text.alias("text"))


def validate(rendered: DataFrame) -> DataFrame:
    """Compares the documented amount with the invoice and checks the required fields."""
    amount, documented = F.col("total_amount"), F.coalesce("documented_amount", F.lit(0))
    gap = F.abs(documented - amount).cast("double")
    pct = F.round(F.try_divide(gap, amount.cast("double")) * 100, 6)
    checked = rendered.withColumns({"pct_diff": pct, "missing_fields": missing_count(F.col("text"), REQUIRED_FIELDS)})
    whole = F.col("missing_fields") == 0
    status = (
        F.when(whole & (F.col("pct_diff") <= APPROVE_PCT), "APPROVED")
        .when(whole & (F.col("pct_diff") <= REMARK_PCT), "APPROVED_WITH_REMARK")
        .otherwise("REJECTED")
    )
    severities = F.create_map(*[F.lit(x) for pair in SEVERITY.items() for x in pair])
    # the six-digit percentage is exact as a decimal, so the two digits shown round half up
    shown = F.col("pct_diff").cast("decimal(18,6)").cast("decimal(18,2)").cast("string")
    shown = F.coalesce(shown, F.lit("unknown"))
    issue = F.concat(F.lit("Amount differs by "), shown, F.lit("% or a required field is missing"))
    rejected = (F.col("status") != "APPROVED").cast("int")
    return checked.withColumn("status", status).select(
        "invoice_id",
        "customer_id",
        F.col("documented_amount").cast("double").alias("documented_amount"),
        F.col("total_amount").cast("double").alias("invoice_amount"),
        "pct_diff",
        "missing_fields",
        "status",
        severities[F.col("status")].alias("severity"),
        F.when(F.col("status") == "APPROVED", "No issues").otherwise(issue).alias("issues"),
        (rejected + F.col("missing_fields")).alias("n_issues"),
    )


def validation_summary(validated: DataFrame) -> DataFrame:
    counts = validated.groupBy("status").agg(F.count(F.lit(1)).alias("n_documents"))
    whole = counts.agg(F.sum("n_documents")).scalar()
    return counts.withColumn("pct_documents", F.round(F.col("n_documents") * 100.0 / whole, 4))


def required_fields(rendered: DataFrame) -> DataFrame:
    """Per required field, in how many documents it is missing."""
    sums = rendered.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(missing_count(F.col("text"), [f]) > 0, 1)).alias(f"m{i}") for i, f in enumerate(REQUIRED_FIELDS)],
    )
    rows = [
        F.struct(F.lit(f).alias("field"), F.col("n").alias("n_documents"), F.col(f"m{i}").alias("n_missing"))
        for i, f in enumerate(REQUIRED_FIELDS)
    ]
    return sums.select(F.inline(F.array(*rows)))


def movements(invoices: DataFrame, payments: DataFrame) -> DataFrame:
    """Invoices as debits and their payments as credits, per customer."""
    debits = invoices.select(
        "customer_id",
        F.col("issue_date").alias("day"),
        F.lit(0).alias("kind"),
        "invoice_id",
        F.lit(0).alias("line_no"),
        F.lit(0).cast("bigint").alias("part_id"),
        F.lit(0).cast("bigint").alias("supplier_id"),
        F.col("amount").cast("decimal(18,4)").alias("movement"),
    )
    credits = payments.join(invoices.select("invoice_id", "customer_id"), "invoice_id").select(
        "customer_id",
        F.col("payment_date").alias("day"),
        F.lit(1).alias("kind"),
        "invoice_id",
        "line_no",
        "part_id",
        "supplier_id",
        (-F.col("amount")).cast("decimal(18,4)").alias("movement"),
    )
    return debits.unionByName(credits)


def statement_lines(moves: DataFrame, ids: DataFrame) -> DataFrame:
    """Running balance per customer, oldest movement first.

    A customer's movements are cut by day and by invoice range, so that the movements of one large customer are ordered
    in many tasks. ``ids`` are the invoices that the ranges are taken from.
    """
    cuts = cut_points(ids.select("invoice_id"), {"invoice_id": TIE_SLOTS})
    rows = add_slots(moves, cuts).withColumn("balance", F.col("movement").cast("decimal(28,4)"))
    order = ["day", "kind", "invoice_id", "line_no", "part_id", "supplier_id"]
    slots = ["day", "kind", "invoice_id_slot"]
    running = running_totals(rows, ["customer_id"], slots, order, {"balance": "balance"})
    return running.drop("invoice_id_slot")


def statement_totals(moves: DataFrame, scores: DataFrame) -> DataFrame:
    """Debits, credits, closing balance, net revenue and its monthly mean per customer, and the approval flag."""
    debit = F.sum(F.when(F.col("kind") == 0, F.col("movement"))).cast("double")
    credit = F.sum(F.when(F.col("kind") == 1, -F.col("movement"))).cast("double")
    first, last = F.min("day"), F.max("day")
    months = (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first) + 1
    totals = moves.groupBy("customer_id").agg(
        F.coalesce(debit, F.lit(0.0)).alias("total_debits"),
        F.coalesce(credit, F.lit(0.0)).alias("total_credits"),
        F.sum("movement").cast("double").alias("closing_balance"),
        months.alias("n_months"),
    )
    net = F.col("total_credits") * NET_SHARE
    scored = scores.select("customer_id", F.round((1 - F.col("probability")) * 1000, 0).cast("int").alias("credit_score"))
    return totals.join(scored, "customer_id").select(
        "*",
        F.round(net, 6).alias("net_revenue"),
        F.round(net / F.col("n_months"), 4).alias("monthly_net_revenue"),
        (F.col("credit_score") > APPROVAL_SCORE).cast("int").alias("approved"),
    )


def top_terms(documents: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` heaviest terms per document by term count times ln(documents / documents with the term).

    Texts are split once, and the counts of a document are written side by side. Terms of more than one row in
    ``COMMON_SHARE`` are that many at most, so their document counts are broadcast; only rows of the others are shuffled
    by term, and none of these terms has many.
    """
    terms = F.explode(words(F.lower("text"))).alias("term")
    counted = documents.repartition("doc_id").select("doc_id", terms).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    tf = stage_files(counted, "terms")
    df = stage_files(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "term-counts")
    n = documents.agg(F.count(F.lit(1)).cast("double")).scalar()
    common = F.col("df") * COMMON_SHARE > df.agg(F.sum("df")).scalar()
    known = tf.join(F.broadcast(df.where(common)), "term", "left")
    rare = known.where("df IS NULL").drop("df").join(df.where(~common), "term")
    weight = F.round(F.col("tf") * F.log(n / F.col("df")), 6)
    # a window over one document's distinct terms; its k first common ones leave before any shuffle
    order = Window.partitionBy("doc_id").orderBy(F.desc("weight"), "term")
    weighted = known.where("df IS NOT NULL").unionByName(rare).withColumn("weight", weight)
    ranked = weighted.withColumn("place", F.row_number().over(order))
    return ranked.filter(F.col("place") <= k).select("doc_id", "place", "term", "tf", "weight")
