"""Texts of very many spans take seconds and give what the plain definitions give."""

import random
import time

from pyspark.sql import functions as F

from duebook.llm import pii

SPANS = "array<struct<start:int,end:int,kind:int>>"


def plain(text, spans):
    at, out = 0, []
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{pii.KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_blocks_equal_the_plain_rules(spark, monkeypatch):
    monkeypatch.setattr(pii, "_CUT", 7)
    chance = random.Random(5)
    rows = []
    for key in range(300):
        text = "".join(chance.choice("aé😀 x") for _ in range(chance.randrange(1, 400)))

        def spans(n):
            starts = sorted(chance.randrange(len(text)) for _ in range(chance.randrange(n)))
            return [(s, min(len(text), s + chance.randrange(1, 12)), chance.randrange(4)) for s in starts]

        rows.append((key, text, spans(90), spans(90)))
    frame = spark.createDataFrame(rows, f"id int, text string, a {SPANS}, b {SPANS}")
    names = "array(" + ", ".join(f"'[{k.upper()}]'" for k in pii.KINDS) + ")"
    replaced = F.expr(f"CASE WHEN size(a) > 0 THEN {pii._replaced('text', 'a', names)} ELSE text END")
    found = {r.id: r for r in frame.select("id", replaced.alias("masked"), F.expr(pii._apart("b", "a")).alias("apart")).collect()}
    for key, text, a, b in rows:
        assert found[key].masked == plain(text, a)
        assert list(map(tuple, found[key].apart)) == [x for x in b if not any(y[0] < x[1] and x[0] < y[1] for y in a)]


def test_fifty_thousand_spans_in_one_text(spark):
    text = "mail a@b.com or 743-555-1234 " * 25_000
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.perf_counter()
    row = pii.find_spans(frame).first()
    assert row.n_email == 25_000 and row.spans.count(",") == 49_999
    masked = pii.mask(frame).first().text
    assert masked == "mail [EMAIL] or [PHONE] " * 25_000
    assert time.perf_counter() - start < 90
