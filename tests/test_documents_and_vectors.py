import numpy as np
import pytest
from pyspark.sql import functions as F

from duebook.functions.text import page_text, words
from duebook.operators import documents, lookup, textvectors, vectors


def chunk_reference(text, size, overlap):
    tokens = text.split()
    return [" ".join(tokens[i : i + size]) for i in range(0, len(tokens), size - overlap)]


@pytest.mark.parametrize("n", [0, 1, 231, 256, 257])
def test_chunk_edges(spark, n):
    text = " \n".join(f"w{i}" for i in range(n))
    df = spark.createDataFrame([(1, text, "en", "s")], "doc_id bigint, text string, lang string, source string")
    got = [r["chunk_text"] for r in documents.chunks(df).orderBy("chunk_index").collect()]
    assert got == chunk_reference(text, 256, 25)
    assert documents.chunk_errors(df).count() == (n == 0)


def test_only_the_first_chunk_has_the_whole_text(spark):
    text = " ".join(map(str, range(600)))
    df = spark.createDataFrame([(5, text, "en", "s")], "doc_id bigint, text string, lang string, source string")
    rows = documents.chunks(df).orderBy("chunk_index").collect()
    assert [r["full_text"] == text for r in rows] == [True, False, False]
    assert rows[1]["chunk_id"] == "5_chunk_1"


def test_unicode_white_space_separates_words(spark):
    text = "a b c　d\te\n f g"
    got = spark.createDataFrame([(text,), ("   ",), (None,)], "t string").select(words(F.col("t"))).collect()
    assert [r[0] for r in got] == [text.split(), [], []]


def test_page_text(spark):
    html = "<html><script>var x='<b>';</script><!-- a > b --><p>Fish &amp; <b>chips</b></p>\n\n\n\n<p>5 &lt; 6</p></html>"
    got = spark.createDataFrame([(html,), (None,)], "h string").select(page_text(F.col("h"))).collect()
    assert got[0][0].split() == ["Fish", "&", "chips", "5", "<", "6"]
    assert "\n\n\n" not in got[0][0] and got[1][0] == ""


def rendered(spark, rows):
    df = spark.createDataFrame(rows, "invoice_id bigint, customer_id bigint, total_amount double, documented_amount double, text string")
    return df.withColumn("total_amount", F.col("total_amount").cast("decimal(18,2)")).withColumn(
        "documented_amount", F.col("documented_amount").cast("decimal(18,4)")
    )


def test_validation_tolerances(spark):
    full = "INVOICE No 1\nIssuer: x\nCustomer: y\nTotal paid: 1"
    rows = [
        (1, 1, 100.0, 102.0, full),
        (2, 1, 100.0, 105.0, full),
        (3, 1, 100.0, 105.1, full),
        (4, 1, 100.0, 100.0, "INVOICE No 4"),
        (5, 1, 100.0, None, full),
    ]
    got = {r["invoice_id"]: (r["status"], r["severity"], r["n_issues"]) for r in documents.validate(rendered(spark, rows)).collect()}
    assert got == {
        1: ("APPROVED", "OK", 0),
        2: ("APPROVED_WITH_REMARK", "LOW", 1),
        3: ("REJECTED", "HIGH", 1),
        4: ("REJECTED", "HIGH", 4),
        5: ("REJECTED", "HIGH", 1),
    }


def test_salted_lookup_equals_join(spark):
    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)], "id int, k string")
    dim = facts.select("k").distinct().withColumn("v", F.length("k"))
    want = sorted(map(tuple, facts.join(dim, "k").select("id", "k", "v").collect()))
    for salts in (1, 16):
        got = lookup.salted_lookup(facts, dim, "k", F.col("id"), salts)
        assert sorted(map(tuple, got.select("id", "k", "v").collect())) == want


def neighbours(queries, corpus, k):
    out = []
    for q, qv in queries:
        d = sorted((round(float(np.sum((np.array(v) - np.array(qv)) ** 2)), 6), i) for i, v in corpus)
        out += [(q, p, i) for p, (_, i) in enumerate(d[:k], 1)]
    return sorted(out)


def test_nearest_by_brute_force_on_both_routes(spark):
    rng = np.random.default_rng(7)
    corpus = [(i, rng.normal(size=4).tolist()) for i in range(60)] + [(100 + i, [0.0] * 4) for i in range(5)]
    queries = [(f"q{i}", rng.normal(size=4).tolist()) for i in range(9)] + [("zero", [0.0] * 4)]
    c = spark.createDataFrame(corpus, "vec_id bigint, vector array<double>").repartition(5)
    q = spark.createDataFrame(queries, "query_id string, vector array<double>")
    want = neighbours(queries, corpus, 4)
    for limit in (100, 3):
        got = vectors.nearest(q, c, 4, max_broadcast=limit, block=(4, 16)).collect()
        assert sorted((r["query_id"], r["place"], r["vec_id"]) for r in got) == want


def test_metadata_filter_limits_the_hits(spark):
    c = spark.createDataFrame([(1, [1.0, 0.0], "a"), (2, [1.0, 0.1], "b"), (3, [0.0, 1.0], "b")], "vec_id bigint, vector array<double>, match string")
    q = spark.createDataFrame([("q", [1.0, 0.0], "b")], "query_id string, vector array<double>, match string")
    got = vectors.nearest(q, c, 5, "cosine", match=["match"]).orderBy("place").collect()
    assert [r["vec_id"] for r in got] == [2, 3]


def test_context_has_the_rule_between_documents(spark):
    docs = spark.createDataFrame([(1, "en", "s", "one"), (2, "en", "s", "two")], "doc_id bigint, lang string, source string, text string")
    hits = spark.createDataFrame([("q", 1, 2, 0.1), ("q", 2, 1, 0.2)], "query_id string, place int, vec_id bigint, distance double")
    row = vectors.context_blocks(hits, docs).first()
    first, second = row["context"].split(f"\n{vectors.RULE}\n")
    assert first.endswith("two") and second.endswith("one") and row["n_documents"] == 2


def test_filter_on_several_columns_and_missing_values(spark):
    kinds = "vec_id bigint, vector array<double>, lang string, year int"
    c = spark.createDataFrame([(1, [1.0], "en", 1), (2, [1.0], "en", 2), (3, [1.0], None, 1), (4, [1.0], "de", 1)], kinds)
    q = spark.createDataFrame([("a", [1.0], "en", 1), ("b", [1.0], None, 1)], "query_id string, vector array<double>, lang string, year int")
    got = vectors.nearest(q, c, 5, "cosine", match=["lang", "year"]).collect()
    assert sorted((r["query_id"], r["vec_id"]) for r in got) == [("a", 1), ("b", 3)]


def test_hit_without_a_document_keeps_its_place(spark):
    docs = spark.createDataFrame([(1, "en", "s", "one")], "doc_id bigint, lang string, source string, text string")
    hits = spark.createDataFrame([("q", 1, 9, 0.1), ("q", 2, 1, 0.2)], "query_id string, place int, vec_id bigint, distance double")
    row = vectors.context_blocks(hits, docs).first()
    assert row["n_documents"] == 2 and row["context"].startswith(f"#1 | document 9\n{vectors.NO_TEXT}\n")


def test_cells_prune_clustered_vectors_and_keep_their_neighbours(spark):
    rng = np.random.default_rng(11)
    centres = rng.normal(scale=10, size=(12, 6))
    corpus = [(i, (centres[i % 12] + rng.normal(size=6)).tolist()) for i in range(360)]
    queries = [(f"q{i}", (centres[i] + rng.normal(size=6)).tolist()) for i in range(12)]
    c = spark.createDataFrame(corpus, "vec_id bigint, vector array<double>")
    q = spark.createDataFrame(queries, "query_id string, vector array<double>")
    rows = vectors.cell_recall(q, c, vectors.nearest(q, c, 3), 3, cells=12, probes=2).collect()
    assert len(rows) == 12 and sum(r["n_found"] for r in rows) >= 0.9 * sum(r["n_exact"] for r in rows)
    assert sum(r["n_candidates"] for r in rows) <= 0.2 * sum(r["n_vectors"] for r in rows)
    whole, _ = vectors.cell_search(q, c, 3, cells=4, probes=4, block=50)
    assert sorted((r["query_id"], r["place"], r["vec_id"]) for r in whole.collect()) == neighbours(queries, corpus, 3)


def test_text_vectors_have_length_one(spark):
    rows = spark.createDataFrame([(1, "a b b"), (2, "A c"), (3, ""), (4, None)], "id bigint, text string")
    counted = textvectors.hashed_counts(rows, "text")
    found = {r["id"]: np.array(r["vector"]) for r in textvectors.unit_vectors(counted, textvectors.fit_rarity(counted)).collect()}
    assert [round(float(found[i] @ found[i]), 9) for i in (1, 2, 3, 4)] == [1, 1, 0, 0] and found[1] @ found[2] > 0


def test_no_query_is_lost_whatever_the_broadcast_bound(spark):
    queries = spark.range(4_200).selectExpr("cast(id AS string) AS query_id", "array(cast(id % 7 AS double), 1.0D) AS vector")
    corpus = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(7)], "vec_id bigint, vector array<double>")
    for bound in (10, 10_000):
        hits = vectors.nearest(queries, corpus, 1, max_broadcast=bound).collect()
        assert len(hits) == 4_200 and all(r["vec_id"] == int(r["query_id"]) % 7 for r in hits)
