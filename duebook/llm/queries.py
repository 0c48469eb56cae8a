"""Named queries over the given tables, one for each operator, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, filter_audit, hmm, licences, middle, minhash, mixing, neighbours, pieces, pii, quality, simhash, toxicity
from .common import stage_table, table

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings", "vec_id", "embedding")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"))


ORACLES["op1_neighbours"] = """
WITH vectors AS (
    SELECT vec_id, min(embedding::DOUBLE[]) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    GROUP BY vec_id
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query
def op2_licence_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(table(spark, folder, "documents", "doc_id", "text"))
    joined = [F.array_join(name, ",").alias(name) for name in ("sequence", "licences", "unmatched")]
    return found.select("doc_id", "n_sentences", *joined)


def _licence_sql() -> str:
    marks = "CASE WHEN len(sequence) > 0 THEN ' ' || replace(array_to_string(sequence, ' '), ' ', '  ') || ' ' ELSE '' END"
    for number, (_, parts) in enumerate(licences.RULES):
        marks = f"replace({marks}, ' {'  '.join(parts)} ', ' #{number} ')"
    names = "[" + ", ".join(f"'{name}'" for name, _ in licences.RULES) + "]"
    return f"""
WITH cut AS (
    SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{licences.CUTS}'), lambda s: regexp_matches(s, '{licences.LETTER}')) AS sentences
    FROM documents
), lined AS (
    SELECT doc_id, CAST(len(sentences) AS BIGINT) AS n_sentences, list_transform(sentences, lambda s: list_filter(list_transform(
        string_split_regex(s, '{licences.STARTS}'),
        lambda l: replace(trim(regexp_replace(lower(l), '[^a-z0-9]+', ' ', 'g')), 'licence', 'license')), lambda l: l <> '')) AS lines
    FROM cut
), named AS (
    SELECT doc_id, n_sentences, list_filter(list_transform(
        flatten(list_transform(lines, lambda p: list_transform(p, lambda l, i: CASE WHEN regexp_matches(l, '{licences.FIRST}')
            THEN regexp_replace(array_to_string(p[i:i + {licences.LINES - 1}], ' '), '{licences.COUNTER}', '') ELSE '' END))),
        lambda w: {licences.identifier('w', 'starts_with')}), lambda s: s <> '') AS sequence
    FROM lined
), ruled AS (
    SELECT *, list_filter(string_split({marks}, ' '), lambda m: m <> '') AS marks FROM named
)
SELECT doc_id, n_sentences, array_to_string(sequence, ',') AS sequence,
    array_to_string(list_transform(list_filter(marks, lambda m: starts_with(m, '#')), lambda m: {names}[CAST(m[2:] AS INT) + 1]), ',') AS licences,
    array_to_string(list_filter(marks, lambda m: NOT starts_with(m, '#')), ',') AS unmatched
FROM ruled
"""


ORACLES["op2_licence_rules"] = _licence_sql()


@query
def op3_hidden_markov(spark: SparkSession, folder: str) -> DataFrame:
    return hmm.score(table(spark, folder, "documents", "doc_id", "text"))[0]


@query
def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "text", "lang")
    members, _, plan = mixing.mix(documents, table(spark, folder, "labels", "doc_id"))
    return mixing.rates(members, plan)


@query
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "text")
    return quality.report(documents, *quality.fit(documents, table(spark, folder, "labels", "doc_id", "quality")))


@query
def op6_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents", "doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents", "doc_id", "text"), table(spark, folder, "labels", "doc_id", "toxic"))


EXTRA_CONVERSATION = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]


@query
def op8_reply_trees(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA_CONVERSATION, "conv_id long, turn long, role string, text string")
    messages = stage_table(chat.from_turns(turns.unionByName(extra)), "messages")
    formatted = chat.format_paths(chat.reply_paths(messages))
    found = chat.digests(formatted.withColumn("conv_id", F.regexp_extract("tree", "^(-?[0-9]+):", 1)))
    names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return found.select(F.expr("try_cast(conv_id AS bigint)").alias("conv_id"), *names)


def _escaped(column: str) -> str:
    out = f"replace(coalesce({column}, ''), '\\', '\\\\')"
    for control in chat.CONTROLS:
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


ORACLES["op8_reply_trees"] = f"""
WITH rows AS (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST) AS place FROM rows
), whole AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' ORDER BY place) AS turns,
        coalesce(string_agg(coalesce(text, ''), '' ORDER BY place) FILTER (role = 'assistant'), '') AS loss,
        sum(length(replace({_escaped("role")}, chr(10), '\\n')) + length({_escaped("text")}) + {len(chat.OPEN) + len(chat.CLOSE) + 1}) AS chars
    FROM placed GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
    CAST(chars AS BIGINT) AS formatted_chars
FROM whole
"""


@query
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_spans(table(spark, folder, "documents", "doc_id", "text"))
    return found.select("doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2(F.col("base"), 256).alias("base_sha256"), "spans")


@query
def op10_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode(table(spark, folder, "documents", "doc_id", "text"), PIECE_MODEL)


@query
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents", "doc_id", "text", "source")
    return filter_audit.audit(documents, table(spark, folder, "labels", "doc_id", "quality", "toxic"))


ORACLES["op11_filter_audit"] = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), firsts AS (SELECT t, min(doc_id) AS first_id FROM docs GROUP BY t),
marks AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
masks AS (
    SELECT part, (len(words) < 200)::INT
        + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
        + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
        + 8 * regexp_matches(t, '[#$%&*|]')::INT
        + 16 * coalesce(doc_id > first_id, false)::INT AS mask,
        coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic
    FROM docs JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)
), cells AS (
    SELECT part, mask, count(*) AS docs, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM masks GROUP BY part, mask
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
), prefixes AS (
    SELECT '' AS prefix, 0 AS step, 0 AS before, 0 AS bit
    UNION ALL SELECT prefix || letter, step + 1, before | p.bit, l.bit FROM prefixes p JOIN letters l ON (before | p.bit) & l.bit = 0
), steps AS (
    SELECT part, prefix, step, right(prefix, 1) AS letter,
        coalesce(sum(docs) FILTER (mask & (before | bit) = 0), 0) AS kept,
        coalesce(sum(docs) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS removed,
        coalesce(sum(docs) FILTER (mask & before > 0 AND mask & bit > 0), 0) AS redundant,
        coalesce(sum(docs) FILTER (mask = bit), 0) AS unique_fails,
        coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS good_lost,
        coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0), 0) AS toxic_lost
    FROM prefixes, cells WHERE step > 0 GROUP BY part, prefix, step, before, bit
), rows AS (
    SELECT s.*, o.prefix AS filter_order FROM prefixes o JOIN steps s ON o.step = 5 AND starts_with(o.prefix, s.prefix)
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
    unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM rows
"""


@query
def op12_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents", "doc_id", "text"))


ORACLES["op12_minhash"] = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(words) = 0 THEN []::VARCHAR[] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
        ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) END AS shingles
    FROM docs
), sizes AS (SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n FROM sets
), items AS (SELECT doc_id, unnest(shingles) AS shingle FROM sets
), pairs AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM items a JOIN items b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
    SELECT u, v FROM pairs p JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), reach AS (
    SELECT doc_id AS u, doc_id AS v FROM sizes UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v
), named AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u)
SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept FROM sizes JOIN named USING (doc_id)
"""


@query
def op13_middle(spark: SparkSession, folder: str) -> DataFrame:
    return middle.digests(middle.cut_pieces(table(spark, folder, "documents", "doc_id", "text")))


ORACLES["op13_middle"] = """
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
        list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), i, 8) AS BIGINT)) AS h
    FROM documents
), formed AS (
    SELECT doc_id, t, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
        CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
             WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM hashed
), parts AS (SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1, n - b) AS s FROM formed)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts
"""
