"""Filter audit, MinHash near-duplicates and fill-in-middle, on cases that SQL over the test tables does not reach."""

import random
from collections import Counter
from hashlib import sha256
from itertools import permutations

import pytest
import xxhash

from duebook.llm import filter_audit, middle, minhash

SCHEMA = "doc_id long, text string, source string"


def brute_audit(rows, labels):
    texts = [(d, s or "", t or "") for d, t, s in rows]
    fails = []
    for d, part, text in texts:
        words = [w for w in text.encode().split()]
        failed = {"A"} if len(words) < 200 else set()
        failed |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        failed |= {"C"} if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text) else set()
        failed |= {"D"} if set(text) & set("#$%&*|") else set()
        failed |= {"E"} if d is not None and any(e is not None and e < d and u == text for e, _, u in texts) else set()
        fails.append((d, part, failed))
    out = {}
    for part in {p for _, p, _ in fails}:
        inside = [(d, f) for d, p, f in fails if p == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                before = set(order[: step - 1])
                gone = [d for d, f in inside if letter in f and not f & before]
                shapley[letter] += len(gone)
                out[part, "".join(order), step] = [
                    sum(not f & {*before, letter} for _, f in inside), len(gone), sum(letter in f and bool(f & before) for _, f in inside),
                    sum(f == {letter} for _, f in inside), sum(labels.get(d, (0, 0))[0] == 1 for d in gone), sum(labels.get(d, (0, 0))[1] == 1 for d in gone),
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return {key: tuple(values) for key, values in out.items()}


def test_audit_equals_brute_force_on_odd_rows(spark):
    words = [f"w{i}" for i in range(260)]
    rows = [
        (1, None, "a"), (2, "", "a"), (None, "", "b"), (None, "", "b"), (3, "", "b"), (3, "", "b"), (4, " ".join(words), "a"), (5, " ".join(words), None),
        (5, "A B C D", None), (6, "é# ÀÀ", "a"), (7, "same " * 300, "c"), (8, "same " * 300, "a"), (0, "same " * 300, ""), (9, "|" + "x" * 300_000, "c"), (9, "AÉ" * 30, "c"),
    ]
    labels = [(1, 1, 0), (1, 0, 1), (5, 1, 1), (3, None, 1), (None, 1, 1), (8, 1, None)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS part", "1 AS mask", "'y' AS same", "7 AS quality", "0 AS docs")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'z' AS part")
    known = {1: (1, 1), 5: (1, 1), 3: (None, 1), 8: (1, None)}
    found = filter_audit.audit(frame, marks).collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in found}
    assert len(got) == len(found) and got == brute_audit(rows, known)


def test_audit_of_nothing_is_empty(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(spark.createDataFrame([], SCHEMA), labels).count() == 0


def test_audit_uses_one_recursion_level_a_step(spark):
    cells = spark.createDataFrame([("a", 0, 5, 0, 0), ("a", 3, 2, 1, 0)], "part string, mask int, docs long, good long, toxic long")
    steps = filter_audit.walk(filter_audit.left_after(cells, "AB"), "AB").collect()
    assert {(r.prefix, r.step, r.kept, r.removed, r.good_lost) for r in steps} == {("A", 1, 5, 2, 1), ("B", 1, 5, 2, 1), ("AB", 2, 5, 0, 0), ("BA", 2, 5, 0, 0)}


def brute_components(texts, percent=85):
    sets = {}
    for key, text in texts:
        words = (text or "").encode().lower().split()
        sets[key] = {tuple(words[i : i + 3]) for i in range(len(words) - 2)} or ({tuple(words)} if words else set())
    root = {key: key for key in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    keys = sorted(sets)
    for x, a in enumerate(keys):
        for b in keys[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                root[max(top(a), top(b))] = min(top(a), top(b))
    return {key: (len(sets[key]), top(key)) for key in sets}


def edited(words, chance, times):
    out = list(words)
    for _ in range(times):
        out[chance.randrange(len(out))] = f"e{chance.randrange(10**9)}"
    return " ".join(out)


@pytest.mark.parametrize("length", [12, 90, 400, 1500])
def test_minhash_finds_every_link_of_edited_copies(spark, length):
    chance = random.Random(length)
    texts, passage = [], " ".join(f"p{i}" for i in range(60))
    for family in range(6):
        base = [f"f{family}w{i}" for i in range(length)]
        texts += [edited(base, chance, chance.randrange(max(2, length // 12))) for _ in range(20)]
        texts.append(" ".join(base) + " " + passage)
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_components(rows)
    assert 1 < len({c for _, c in want.values()}) < len(rows)
    for block in (3, minhash.BLOCK):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame, block=block).collect()}
        assert got == want


def test_minhash_takes_odd_documents(spark, odd_documents):
    found = minhash.near_duplicates(odd_documents).collect()
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found)
    assert got == Counter({(1, 0, 1, True): 1, (2, 0, 2, True): 1, (3, 0, 3, True): 1, (4, 2, 4, True): 2, (None, 2, None, True): 1, (5, 2, 5, True): 1, (6, 1, 6, True): 1})
    assert minhash.near_duplicates(odd_documents.limit(0)).count() == 0


def test_minhash_at_the_threshold_and_with_a_null_id(spark):
    # 17 of 20 shingles shared is 85 percent exactly, 16 of 19 is less.
    base = [f"a{i}" for i in range(19)]
    rows = [(3, " ".join(base)), (1, " ".join([*base, "b0", "b1", "b2"])), (2, " ".join([*base[:18], "c0", "c1"])), (None, " ".join(base).upper()), (9, "x y"), (8, "X  Y")]
    found = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {(3, 1, False), (1, 1, True), (2, 2, True), (None, 1, False), (9, 8, False), (8, 8, True)}


def test_minhash_needs_no_more_than_similar_sets_share(spark):
    sizes = spark.range(1, 5_000).withColumnRenamed("id", "n")
    for kept in (minhash.RETAINED, minhash.LISTED):
        whole, needed = minhash.least_overlap(85, kept)
        for r in sizes.select("n", needed.alias("needed")).collect():
            assert 1 <= r.needed <= min(r.n, whole) and (r.n > kept or r.needed <= -(-85 * r.n // 100))


def apart(text, form):
    if form == "plain":
        return text
    marks = {m: text.index(m) for m in middle.MARKS}
    places = sorted([*marks.values(), len(text)])
    part = {m: text[at + 3 : places[places.index(at) + 1]] for m, at in marks.items()}
    return part["<P>"] + part["<M>"] + part["<S>"]


@pytest.mark.parametrize("chunk", [1, 7, middle.CHUNK])
def test_middle_round_trips_in_small_pieces(spark, chunk):
    chance = random.Random(chunk)
    texts = ["".join(chance.choice("aé漢😀 \n<PSM>\x00") for _ in range(chance.randrange(60))) for _ in range(120)]
    texts += [None, "", "x", "a<P>b", "<M>", "<P", "ß" * 5_000]
    rows = [*enumerate(texts), (None, "no id at all"), (None, "another"), (5, texts[5]), (5, texts[5]), (5, "other text of 5")]
    pieces = middle.cut_pieces(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS at", "'x' AS piece"), chunk)
    found, outputs = middle.digests(pieces).collect(), middle.restore(middle.outputs(pieces)).collect()
    want = Counter((d, sha256((t or "").encode()).hexdigest()) for d, t in rows)
    assert Counter((r.doc_id, r.restored_sha256) for r in found) == want == Counter((r.doc_id, sha256(r.text.encode()).hexdigest()) for r in outputs)
    assert Counter((r.doc_id, r.output_sha256) for r in found) == Counter((r.doc_id, sha256(r.output.encode()).hexdigest()) for r in outputs)
    for r in outputs:
        form, first, second = middle.plan(r.doc_id, r.text)
        assert apart(r.output, r.form) == r.text and r.form == form and r.n == len(r.text)
        assert (r.prefix_chars, r.middle_chars) == ((None, None) if form == "plain" else (first, second - first))
    assert {r.form for r in outputs} == {"plain", "psm", "spm"}


def test_middle_takes_odd_documents_and_shuffles_once(spark, odd_documents):
    pieces = middle.cut_pieces(odd_documents)
    found = middle.digests(pieces)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 2
    assert Counter((r.doc_id, r.restored_sha256) for r in found.collect()) == Counter((r.doc_id, sha256((r.text or "").encode()).hexdigest()) for r in odd_documents.collect())
    assert middle.digests(middle.cut_pieces(odd_documents.limit(0))).count() == 0


def test_shingles_hash_with_the_stated_seed():
    assert minhash.shingle_hashes(b"A b C").view("uint64").tolist() == [xxhash.xxh64_intdigest(b"a b c", 42)]
