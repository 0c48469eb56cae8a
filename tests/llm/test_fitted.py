"""Fitted operators, odd inputs and the pipeline."""

import numpy as np
import pytest

import corpus_pipeline
from duebook.llm import chat, hmm, licences, mixing, near_copies, pieces, pii, quality, simhash, toxicity
from duebook.llm.common import few_rows
from duebook.llm.queries import PIECE_MODEL, QUERIES


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")


def test_odd_documents(spark, odd_documents, labels):
    n = odd_documents.count()
    assert hmm.score(odd_documents)[0].where("score < 0").count() == n
    members, _, plan = mixing.mix(odd_documents, labels)
    assert mixing.rates(members, plan).where("rate >= 0").count() == n
    assert quality.report(odd_documents, *quality.fit(odd_documents, labels)).count() == n
    assert simhash.near_duplicates(odd_documents).count() == n
    assert toxicity.score(odd_documents, labels).where("score BETWEEN 0 AND 1").count() == n
    assert pii.find_spans(odd_documents).count() == n and pii.mask(odd_documents).columns == odd_documents.columns
    assert pieces.encode(odd_documents, PIECE_MODEL).where("parity AND round_trip").count() == n
    assert licences.scan(odd_documents).count() == n
    kept = near_copies.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns and sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == [1, 4, 5, 6]


def test_keep_one_keeps_a_row_of_each_component(spark):
    words = [f"{a} {b} and some words of its own number {i}" for i, (a, b) in enumerate(zip("abcdefgh", "stuvwxyz", strict=True))]
    rows = [(None, w, 0) for w in words[:5]] + [(None, words[0], 0), (7, words[5], 0), (7, words[6], 0), (3, words[6], 0), (9, words[7], 0), (2, "", 0), (2, None, 0), (2, None, 0)]
    rows += [(8, "one  more", 0), (8, "one more", 0), (8, "One more", 0), (None, words[7], 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, key_of_row int")
    kept = near_copies.keep_one(frame)
    want = [(None, w, 0) for w in words[:5]] + [(7, words[5], 0), (3, words[6], 0), (9, words[7], 0), (2, None, 0), (8, "One more", 0)]
    assert kept.columns == frame.columns and sorted(map(tuple, kept.collect()), key=str) == sorted(want, key=str)


def test_empty_tables(spark, odd_documents, labels):
    none, no_labels = odd_documents.where("false"), labels.where("false")
    members, _, plan = mixing.mix(none, no_labels)
    found = [
        hmm.score(none)[0], mixing.rates(members, plan), quality.report(none, *quality.fit(none, no_labels)), simhash.near_duplicates(none), near_copies.keep_one(none),
        toxicity.score(none, no_labels), pii.find_spans(none), pii.mask(none), pieces.encode(none, PIECE_MODEL), licences.scan(none),
        chat.format_paths(chat.reply_paths(spark.createDataFrame([], "id string, parent string, role string, text string, score double"))),
    ]
    assert [f.count() for f in found] == [0] * len(found)


def test_quality_threshold():
    assert quality.choose_threshold([(0.5, 1), (0.4, 1), (0.1, 0)]) == pytest.approx(0.25)
    assert quality.choose_threshold([(0.5, 1)]) == 0.5 and quality.choose_threshold([]) == -np.inf


def test_quality_rejects_junk(spark):
    chance = np.random.default_rng(2)
    good = [" ".join(chance.choice(["the", "of", "house", "tree", "runs", "old", "river", "with"], 80)) for _ in range(120)]
    junk = [" ".join(w + "&&&" for w in chance.choice(["tree", "runs", "old", "zz"], 80)) for _ in range(120)]
    rows = [(i, t) for i, t in enumerate(good + junk)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i < 120)) for i in range(240) if i % 3], "doc_id long, quality int")
    found = {r.doc_id: r for r in quality.report(docs, *quality.fit(docs, marks)).collect()}
    clear = [i for i in found if not found[i].base_failed]
    assert len(clear) > 100 and all(found[i].kept == (i < 120) for i in clear)


@pytest.mark.parametrize("odd", [0, 1])
def test_quality_learns_from_ids_of_one_parity(spark, odd):
    chance = np.random.default_rng(2)
    good = [" ".join(chance.choice(["the", "of", "house", "tree", "runs", "old", "river", "with"], 80)) for _ in range(60)]
    junk = [" ".join(w + "&&&" for w in chance.choice(["tree", "runs", "old", "zz", "a", "b", "c", "d"], 80)) for _ in range(60)]
    docs = spark.createDataFrame([(2 * i + odd, t) for i, t in enumerate(good + junk)], "doc_id long, text string")
    marks = spark.createDataFrame([(2 * i + odd, int(i < 60)) for i in range(120)], "doc_id long, quality int")
    ratios, threshold = quality.fit(docs, marks)
    clear = quality.report(docs, ratios, threshold).where("NOT base_failed").collect()
    assert np.isfinite(threshold) and {r.doc_id < 120 for r in clear} == {True, False}
    assert all(r.kept == (r.doc_id < 120) for r in clear)


def test_rates_meet_targets(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    marks = spark.read.parquet(f"{folder}/labels.parquet")
    members, model, plan = mixing.mix(docs, marks)
    rows = mixing.rates(members, plan).collect()
    reached = np.sum([np.array(r.membership) * r.n_tokens * r.rate for r in rows], axis=0)
    assert np.abs(reached / plan.targets - 1).max() < 0.01
    guess = {r.doc_id: model.domains[int(np.argmax(r.membership))] for r in rows}
    truth = {r.doc_id: r.lang for r in docs.where("n_chars > 200").collect()}
    assert np.mean([guess[i] == lang for i, lang in truth.items()]) > 0.85
    again = mixing.remix(docs, model, plan)
    assert again.columns == docs.columns and again.count() == sum(r.copies for r in rows)


def test_toxicity_on_held_out_rows(spark):
    chance = np.random.default_rng(3)
    plain, rude = ["the", "of", "house", "tree", "runs", "old", "river", "with"], ["scum", "moron"]
    rows = []
    for i in range(400):
        words = list(chance.choice(plain, 60))
        if i % 3 == 0:
            for at in chance.integers(0, 60, 3):
                words[at] = str(chance.choice(rude))
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)], "doc_id long, toxic int")
    found = toxicity.score(docs, marks).where("held_out").collect()
    assert len(found) > 40 and np.mean([r.predicted == (r.doc_id % 3 == 0) for r in found]) > 0.97


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}


def first_of_near_copies(rows):
    """Smallest doc_id of each group of texts linked by a five-word similarity of 0.8, by comparing all."""
    sets, root = {d: shingle_set(t) for d, t in rows}, {d: d for d, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                root[max(top(a), top(b))] = min(top(a), top(b))
    return {top(d) for d in sets}


def test_near_copies_between_the_threshold_and_equality_are_found(spark):
    chance = np.random.default_rng(11)
    rows, pairs = [], []
    for pair in range(150):
        words = [f"p{pair}w{i}" for i in range(chance.integers(60, 400))]
        copy = list(words)
        for place in chance.choice(len(words), max(1, round(len(words) * chance.uniform(0.005, 0.022))), replace=False):
            copy[place] = f"new{pair}x{place}"
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(copy))]
        a, b = shingle_set(rows[-2][1]), shingle_set(rows[-1][1])
        pairs.append(len(a & b) / len(a | b))
    kept = {r.doc_id for r in near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    close = [i for i, similarity in enumerate(pairs) if similarity >= 0.8]
    found = [i for i in close if 2 * i + 1 not in kept]
    assert len(close) > 80 and len(found) >= 0.9 * len(close)
    assert all(2 * i in kept for i in range(150)) and all(2 * i + 1 in kept for i, similarity in enumerate(pairs) if similarity < 0.8)


def test_a_large_family_of_copies_leaves_one_row_in_any_blocks(spark):
    chance = np.random.default_rng(5)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join([*base[:place], f"e{i}", *base[place + 1 :]]) for i, place in enumerate(chance.integers(0, 200, 300))]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.doc_id for r in near_copies.keep_one(frame).collect()] == [0]
    nodes = near_copies.minhash.sketches(frame, 1 << 30, 5).selectExpr("node", "sketch AS whole")
    edges = near_copies.candidate_pairs(nodes, block=16)
    assert near_copies.components(edges).select("root").distinct().count() == 1


def test_forest_takes_the_nearest_pairs():
    prints = np.random.default_rng(3).integers(0, 1 << 62, (60, 2)).astype(np.uint64)
    prints[1] = prints[0] ^ np.uint64(1)
    prints[2] = prints[0] ^ np.uint64(6)
    far = np.bitwise_count(prints[:, None] ^ prints[None]).sum(2)
    for apart in (1, 3, 60):
        edges = near_copies.nearest_forest(prints, prints, apart)
        root, total = list(range(60)), 0
        for d, a, b in sorted((far[a, b], a, b) for a in range(60) for b in range(a)):
            if d <= apart and root[a] != root[b]:
                total, old, new = total + d, root[a], root[b]
                root = [new if r == old else r for r in root]
        assert sum(far[a, b] for a, b in edges) == total and len(edges) == 60 - len(set(root))
    cross = near_copies.nearest_forest(prints[:1], prints[1:], 4)
    assert sorted(cross) == [(0, 0), (0, 1)]


def test_pipeline_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    (_, rules), (_, dedup), (_, hide), (_, mix), (_, encode) = corpus_pipeline.STAGES
    kept = rules(spark, docs, folder)
    assert kept.schema == docs.schema
    ids = {r.doc_id for r in QUERIES["op5_quality_rules"](spark, folder).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == ids
    single = dedup(spark, kept, folder)
    first = first_of_near_copies([(r.doc_id, r.text) for r in kept.collect()])
    assert {r.doc_id for r in single.collect()} == first
    hidden = hide(spark, single, folder)
    assert hidden.columns == docs.columns and not pii.find_spans(hidden).where("base <> ''").count()
    mixed = mix(spark, hidden, folder)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.select("doc_id").collect()} == first
    assert encode(spark, mixed, folder).count() == mixed.count()


def test_the_driver_takes_no_more_rows_than_promised(spark):
    rows = spark.range(0, 40, 1, 7)
    assert sorted(r.id for r in few_rows(rows, 40)) == list(range(40)) and few_rows(rows.where("id < 0"), 0) == []
    with pytest.raises(ValueError):
        few_rows(rows, 39)
