"""Operators whose results SQL or brute force gives exactly."""

import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import duckdb
import numpy as np
import pytest
import xxhash

from duebook.llm import chat, hmm, licences, neighbours, pieces, pii, quality, simhash
from duebook.llm.common import table
from duebook.llm.queries import ORACLES, PIECE_MODEL, QUERIES

TABLES = ("documents", "embeddings", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, folder, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    want = con.sql(ORACLES[name]).df()
    got = QUERIES[name](spark, folder).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert sorted(got[columns].itertuples(index=False, name=None), key=str) == sorted(want[columns].itertuples(index=False, name=None), key=str)


def test_neighbours_ignore_unusable_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [1.0]), (7, [None, 1.0]), (1, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = neighbours.nearest(frame, frame.where("vec_id = 0"), 20).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(found, key=lambda r: r["rank"])] == [(1, 1, 1.0), (2, 2, 0.5)]
    assert neighbours.nearest(frame.where("vec_id > 99"), frame).count() == 0


@pytest.mark.parametrize("dimension", [3, 64, 300])
def test_estimates_from_packed_bits_keep_their_bounds(dimension):
    chance = np.random.default_rng(7)
    vectors = chance.normal(size=(4000, dimension)) * chance.uniform(0.1, 5, (4000, 1))
    turn = neighbours.rotation(dimension, max(256, -(-dimension // 64) * 64))
    codes = neighbours.Codes(*neighbours.encode(vectors, turn))
    for query in vectors[:20]:
        guess, width = codes.estimate(query @ turn)
        other = np.arange(4000) >= 20
        inside = np.abs(guess - vectors @ query) <= width
        assert inside[other].mean() > 0.97
        signs = np.where(vectors @ turn > 0, 1.0, -1.0)
        assert np.abs(guess - (signs @ (query @ turn)) * codes.scale).max() <= 6 * codes.scale.max() * np.sqrt(query @ query)


def test_neighbours_over_many_blocks(spark, folder, monkeypatch):
    vectors = table(spark, folder, "embeddings", "vec_id", "embedding")
    whole = neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0")).collect()
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 5)
    monkeypatch.setattr(neighbours, "VECTOR_BLOCK", 60)
    assert sorted(neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0")).collect()) == sorted(whole)


def test_neighbours_reach_all_true_ones(spark, folder):
    vectors = table(spark, folder, "embeddings", "vec_id", "embedding")
    data = {r.vec_id: np.array(r.embedding, float) for r in vectors.collect()}
    truth = []
    for q in (i for i in data if i % 20 == 0):
        scored = sorted(((-float(data[q] @ v), i) for i, v in data.items() if i != q))[:20]
        truth += [(q, i) for _, i in scored]
    found = neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"))
    assert neighbours.recall(found, spark.createDataFrame(truth, "query_id long, vec_id long")) >= 0.99


def test_licence_rules_match_sequences(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software. The above copyright notice and this permission notice shall be included in all copies. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND."
    text = f"Licensed under the Apache License, Version 2.0.\n{mit}\nReleased under the MIT License. Neither the name of X may be used."
    row = licences.scan(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert row[0].licences == ["Apache-2.0", "MIT", "MIT"] and row[0].unmatched == ["BsdName"]
    assert row[1].licences == [] and row[1].n_sentences == 0


APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
    http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS."""
UNSIGNED = "Unless required by applicable law or agreed to in writing, software is given as it is. Neither - the name of X"


def test_licence_scan_passes_over_no_known_sentence(spark):
    texts = [*(text for text, _ in licences.SENTENCES), APACHE, UNSIGNED, *(f"// {text.replace(' ', '  ').upper()}" for text, _ in licences.SENTENCES)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in licences.scan(frame).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    for doc_id, n_sentences, *names in con.sql(ORACLES["op2_licence_rules"]).fetchall():
        r = found[doc_id]
        assert (r.n_sentences, *(",".join(x) for x in (r.sequence, r.licences, r.unmatched))) == (n_sentences, *names)
    known = len(licences.SENTENCES)
    assert found[known].licences == ["Apache-2.0"] and found[known].unmatched == [] and found[known + 1].sequence == ["Apache2AsIs", "BsdName"]


MIT_NOTICE = """Copyright (c) 2020 A. Person

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED."""
BSD_NOTICE = """Copyright 2020 A. Person
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice,
   this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse products.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS
IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
GPL_NOTICE = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY.  See the GNU General Public License for more details.

You should have received a copy of the GNU General Public
License along with this program."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS."""
ISC_NOTICE = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES."""
NOTICES = [(MIT_NOTICE, ["MIT"]), (BSD_NOTICE, ["BSD-3-Clause"]), (GPL_NOTICE.format(":"), ["GPL-any"]), (GPL_NOTICE.format(";"), ["GPL-any"]), (APACHE_NOTICE, ["Apache-2.0"]), (ISC_NOTICE, ["ISC"])]


def test_licence_scan_reads_wrapped_notices_with_comment_signs(spark):
    def commented(notice, first, sign, last):
        return first + "\n".join(f"{sign} {line}".rstrip() for line in notice.split("\n")) + last

    signs = [("", "", ""), ("", "#", "\nimport os"), ("", "//", "\n"), ("/*\n", " *", "\n */\nint main() {}"), ("", ";;", ""), ("", "--", "")]
    cases = [(commented(notice, *sign), names) for notice, names in NOTICES for sign in signs]
    cases += [(notice.replace("\n", "\r\n"), names) for notice, names in NOTICES]
    cases += [(" ".join(BSD_NOTICE.split()), ["BSD-3-Clause"]), ("/* SPDX-License-Identifier: MIT */\nint a;", ["MIT"]), ("Title of a page\nReleased under the\nMIT Licence\nand more", ["MIT"])]
    cases += [(f"{MIT_NOTICE}\n\n{GPL_NOTICE.format(':')}", ["MIT", "GPL-any"]), ("word\n" * 200_000 + "licence", []), (MIT_NOTICE.replace("granted", "not granted"), [])]
    frame = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "doc_id long, text string")
    found = {r.doc_id: r for r in licences.scan(frame).collect()}
    assert {i: r.licences for i, r in found.items()} == {i: names for i, (_, names) in enumerate(cases)}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(i, text) for i, (text, _) in enumerate(cases)])
    for doc_id, n_sentences, *names in con.sql(ORACLES["op2_licence_rules"]).fetchall():
        r = found[doc_id]
        assert (r.n_sentences, *(",".join(x) for x in (r.sequence, r.licences, r.unmatched))) == (n_sentences, *names)


def test_roles_with_line_ends_and_control_strings_are_read_back(spark):
    turns = [(1, 0, "a\nb", "c\\n"), (1, 1, "\\n</s>\n", "\nd"), (1, 2, None, None), (1, 3, "assistant", "\n"), (None, 0, None, "x"), (None, 1, "n", "y\\")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rows = chat.format_paths(chat.reply_paths(chat.from_turns(frame))).collect()
    found = {r.tree.split(":")[0]: chat.read(r.formatted) for r in rows}
    assert found == {"1": [("a\nb", "c\\n"), ("\\n</s>\n", "\nd"), ("", ""), ("assistant", "\n")], "null": [("", "x"), ("n", "y\\")]}
    assert {r.tree.split(":")[0]: [chat.unescape(r.formatted[s.start : s.end]) for s in r.loss] for r in rows} == {"1": ["\n"], "null": []}


def brute_prints(texts):
    out = {}
    for key, text in texts.items():
        words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
        grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        out[key] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return out


def test_near_duplicates_equal_brute_force(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    prints = brute_prints({r.doc_id: r.text for r in docs.collect()})
    root = {i: i for i in prints}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2 and top(a) != top(b):
                root[max(top(a), top(b))] = min(top(a), top(b))
    got = QUERIES["op6_simhash_dedup"](spark, folder).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{prints[i]:016x}", top(i)) for i in ids}


def test_chain_of_links_is_one_component_in_small_blocks(spark):
    chain = [0]
    for step in range(12):
        chain.append(chain[-1] | 3 << 5 * step % 62)
    frame = spark.createDataFrame([(p if p < 1 << 63 else p - (1 << 64),) for p in {*chain, 0x5A5A5A5A5A5A5A5A}], "print long")
    for visitors in (1, 2, simhash.VISITORS):
        edges = {(r.u, r.v) for r in simhash.links(frame, block=1, visitors=visitors).collect()}
        nodes, reached = {c for c in chain}, {0}
        while more := {v for u, v in edges if u in reached} | {u for u, v in edges if v in reached} - reached:
            if more <= reached:
                break
            reached |= more
        assert reached == nodes
        assert all((u ^ v).bit_count() <= 2 for u, v in edges)


def test_every_anchor_has_one_home_and_reaches_all_near(spark):
    prints = np.random.default_rng(1).integers(-(2**62), 2**62, 50)
    steps = simhash.anchor_steps(2)
    home, near = {}, {}
    for index, anchor, is_home in simhash.anchors(prints, steps):
        for i, a in zip(index.tolist(), anchor.tolist(), strict=True):
            near.setdefault(i, set()).add(a)
            if is_home:
                assert i not in home
                home[i] = a
    flipped = prints ^ np.int64(1 << 3) ^ np.int64(1 << 30)
    other = {i: a for index, anchor, is_home in simhash.anchors(flipped, steps) if is_home for i, a in zip(index.tolist(), anchor.tolist(), strict=True)}
    assert len(home) == 50 and all(other[i] in near[i] for i in home)


def test_base_score_of_the_language_model(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text")
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [None] for r in docs.collect()}
    counts = Counter(t for i, words in texts.items() if crc32(str(i).encode()) % 7 != 2 for t in words)
    total, distinct = sum(counts.values()), len(counts)
    scored, history = hmm.score(docs)
    rows = scored.collect()
    assert len(rows) == len(texts) and history == sorted(history)
    for r in rows:
        words = texts[r.doc_id]
        base = sum(np.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), total)
        assert r.base_score == pytest.approx(base, abs=1e-6) and r.held_out == (crc32(str(r.doc_id).encode()) % 7 == 2)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_forward_recursion_equals_enumeration_and_stretches():
    chance = np.random.default_rng(5)
    states = 3
    draw = lambda *shape: chance.dirichlet(np.ones(shape[-1]), shape[:-1])
    model = hmm.Model(draw(states), draw(states, states), draw(states, hmm.CLASSES).T)
    rows = [chance.integers(0, hmm.CLASSES, n).astype(np.int32) for n in (1, 2, 7, 23)]
    whole = hmm.sequence_logs([r.tobytes() for r in rows], model)
    cut = hmm.sequence_logs([r.tobytes() for r in rows], model, stretch=3)
    for row, a, b in zip(rows, whole, cut, strict=True):
        alpha = model.start * model.emissions[row[0]]
        for t in row[1:]:
            alpha = (alpha @ model.moves) * model.emissions[t]
        assert a == pytest.approx(np.log10(alpha.sum())) == pytest.approx(b)


def test_repeated_words_and_lines():
    words = quality._Words()
    text = b"a b c d a b c\n\nx y\nx y\n \n \nq"
    assert quality.repeated_words(words.of(text.split())) == 6
    assert quality.repeated_lines(text) == 1
    assert quality.repeated_words(words.of(b"a a a a".split())) == 4


def test_quality_base_counts_equal_brute_force(spark, folder):
    texts = {r.doc_id: r.text or "" for r in table(spark, folder, "documents", "doc_id", "text").collect()}
    for r in QUERIES["op5_quality_rules"](spark, folder).collect():
        text = texts[r.doc_id]
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen, dup = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        twice = {g for g, n in Counter(grams).items() if n > 1}
        repeats = len({j for i, g in enumerate(grams) if g in twice for j in range(i, i + 3)})
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, repeats)
        assert r.base_failed == (len(words) < 50 or 100 * repeats > 50 * len(words)) and not (r.kept and r.base_failed)


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    out = []
    for place, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.group().split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x for *_, x in sorted(out))


def test_fixed_spans_equal_plain_patterns(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text").collect()
    hard = ["a@b.c.d%x@y.z a@b..c x@y.z. 1.2.3.4.5.6.7.8 300.1.1.1 0255.1.2.3", "é😀 4465758382889437 4465-7583-8288-9437 +1 (743) 555-3824", "a@b.c@d.e.f +12 345 678 9", "@.@a.b +1-", "1 2 3 4 12"]
    rows = [(r.doc_id, r.text) for r in docs] + [(-1 - i, t) for i, t in enumerate(hard)]
    found = {r.doc_id: r for r in pii.find_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for key, text in rows:
        want = plain_spans(text or "")
        assert found[key].base == want
        assert set(filter(None, want.split(","))) <= set(filter(None, found[key].spans.split(",")))


def test_added_spans_and_masks(spark):
    text = "call 743-555-1234 or mail bob at site dot com, 4465758382889437 4465758382889437 end"
    frame = spark.createDataFrame([(1, text), (2, "nothing"), (3, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.find_spans(frame).collect()}
    assert [s.split(":")[0] for s in rows[1].spans.split(",")] == ["phone", "email", "card", "card"]
    masked = {r.doc_id: r.text for r in pii.mask(frame).collect()}
    assert masked == {1: "call [PHONE] or mail [EMAIL], [CARD] [CARD] end", 2: "nothing", 3: None}


def test_personal_data_runs_no_python(spark, folder):
    plan = QUERIES["op9_pii"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_branching_trees(spark):
    rows = [
        ("a", None, "user", "q", 0.0), ("b", "a", "assistant", "bad", 1.0), ("c", "a", "assistant", "good\\ <s>", 5.0), ("d", "c", "user", None, 1.0),
        ("e", None, "user", "alone", None), ("x", "y", "user", "loop", 1.0), ("y", "x", "user", "loop", 1.0),
    ]
    frame = spark.createDataFrame(rows, "id string, parent string, role string, text string, score double")
    found = {(r.tree, r["rank"]): r for r in chat.format_paths(chat.reply_paths(frame, keep=2)).collect()}
    assert chat.read(found["a", 1].formatted) == [("user", "q"), ("assistant", "good\\ <s>"), ("user", "")]
    assert chat.read(found["a", 2].formatted) == [("user", "q"), ("assistant", "bad")]
    span = found["a", 1].loss[0]
    assert chat.unescape(found["a", 1].formatted[span.start : span.end]) == "good\\ <s>" and set(found) == {("a", 1), ("a", 2), ("e", 1)}


def test_long_thread(spark):
    turns = spark.createDataFrame([(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(700)], "conv_id long, turn long, role string, text string")
    row = chat.digests(chat.format_paths(chat.reply_paths(chat.from_turns(turns)))).collect()
    whole = "".join(f"{'assistant' if i % 2 else 'user'}\nt{i}\n" for i in range(700))
    assert len(row) == 1 and row[0].n_turns == 700 and row[0].turns_sha256 == sha256(whole.encode()).hexdigest()


def test_pieces_equal_the_library_and_round_trip(spark, folder):
    texts = [r.text or "" for r in table(spark, folder, "documents", "text").collect()]
    texts += ["", "  a  b ", "</s><s> x", "▁a ▁▁ b", "\x00\n\t é漢字😀", " lead", "trail ", "a b"]
    assert all(pieces.whole_parity(texts, PIECE_MODEL))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoded = pieces.encode(frame, PIECE_MODEL)
    rows = {r.doc_id: r for r in encoded.collect()}
    whole = pieces.build(open(PIECE_MODEL, "rb").read()).encode_batch_fast(texts, add_special_tokens=False)
    assert all(rows[i].ids == e.ids and rows[i].parity for i, e in enumerate(whole))
    assert [i for i, t in enumerate(texts) if not rows[i].round_trip] == [texts.index("▁a ▁▁ b")]
    back = {r.doc_id: r.text for r in pieces.decode(encoded, PIECE_MODEL).collect()}
    assert all(back[i] == t for i, t in enumerate(texts) if "▁" not in t)


def test_words_in_runs_equal_words_alone(monkeypatch):
    encoder = pieces.Encoder(open(PIECE_MODEL, "rb").read(), 1)
    monkeypatch.setattr(pieces, "REMEMBERED_WORDS", 40)
    texts = ["  ".join(f"w{i * j}é\x00" for j in range(30)) + f" x{i}\n漢 same words again" for i in range(12)]
    for text in [*texts, *texts]:
        ids, back, same = encoder.encode([text])
        assert ids[0].tolist() == encoder.library.encode(text) and back == [True] and same == [True]
    assert len(encoder.place) < 120
