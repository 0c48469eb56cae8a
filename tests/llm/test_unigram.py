"""Small unigram models, written by hand: ids equal the library's whatever a text spells."""

import random
import struct

import pytest

from duebook.llm import pieces


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def message(number, body):
    return varint(number << 3 | 2) + varint(len(body)) + body


def flag(number, value):
    return varint(number << 3) + varint(value)


def model(fallback=True, prefix=True, extra_spaces=False):
    known = [("<unk>", 0.0, pieces.UNKNOWN), ("<s>", 0.0, pieces.CONTROL), ("</s>", 0.0, pieces.CONTROL)]
    if fallback:
        known += [(f"<0x{b:02X}>", 0.0, pieces.BYTE) for b in range(256)]
    words = ["\u2581", "a", "b", "s", "<", ">", "/", "ab", "\u2581a", "\u2581ab", "ba", "x", "0", "4", "1", "\u2581<", "1>"]
    known += [(w, -1.5 - 0.13 * i, pieces.NORMAL) for i, w in enumerate(words)]
    body = b"".join(
        message(1, message(1, piece.encode()) + varint(2 << 3 | 5) + struct.pack("<f", score) + flag(3, kind)) for piece, score, kind in known
    )
    trainer = flag(3, pieces.UNIGRAM) + flag(35, int(fallback))
    normaliser = message(1, b"identity") + flag(3, int(prefix)) + flag(4, int(extra_spaces)) + flag(5, 1)
    return body + message(2, trainer) + message(3, normaliser)


@pytest.mark.parametrize("fallback", [True, False])
@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("extra_spaces", [True, False])
def test_ids_equal_the_library(fallback, prefix, extra_spaces):
    import sentencepiece

    proto = model(fallback, prefix, extra_spaces)
    library = sentencepiece.SentencePieceProcessor(model_proto=proto)
    chance = random.Random(3)
    parts = ["<s>", "</s>", "<0x41>", "<unk>", "ab", "a", " ", "  ", "ba", "é", "😀", "x", "\u2581", "\n"]
    texts = ["", "</s><s> x", "<0x41>", " ab  ba "] + ["".join(chance.choice(parts) for _ in range(chance.randrange(1, 9))) for _ in range(200)]
    encoder = pieces.Encoder(proto, 1)
    ids, back, same = encoder.encode(texts)
    assert [list(map(int, i)) for i in ids] == library.encode(texts)
    # the pipeline itself spells no control piece
    assert 1 not in set().union(*map(set, map(lambda t: encoder.tokenizer.encode(t, add_special_tokens=False).ids, texts)))
    plain = [i for i, t in enumerate(texts) if "<0x" not in t and "<unk>" not in t and "\u2581" not in t and not set(t) & set("é😀\n") and t.strip() == t and "  " not in t]
    assert plain and all(same[i] for i in plain)
    if fallback and prefix and not extra_spaces:
        assert all(b for t, b in zip(texts, back, strict=True) if "\u2581" not in t and "<0x" not in t)


def test_the_spark_operator_takes_a_unigram_model(spark, tmp_path):
    path = tmp_path / "unigram.model"
    path.write_bytes(model())
    rows = [(1, "</s><s> x"), (2, None), (3, "ab ab é")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    encoded = pieces.encode(frame, str(path))
    assert {r.doc_id: r.text for r in pieces.decode(encoded, str(path)).collect()} == {k: t or "" for k, t in rows}
