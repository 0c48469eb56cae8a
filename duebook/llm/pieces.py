"""SentencePiece models on the tokenizers library.

The model file is a protobuf message; its few fields are read here, and the normaliser (character map, dummy prefix,
extra spaces), the metaspace mark, the scores (unigram) or merges (BPE, ordered by the score of the merged piece), the
unknown piece and byte fallback are rebuilt as a tokenizers pipeline. If no piece has a mark after another character,
no piece can cross the start of a word, so a task encodes each distinct word once (up to a bound it remembers) and
joins the ids of a text's words. Words and, where that property fails, whole texts are encoded in batches by several
threads.

The model is read once on the driver and travels with the tasks; the path is a parameter.

The round trip and parity with the sentencepiece library are checked on whatever is encoded: on runs of new words, or on
each word of a run that fails, which by the same property holds for the whole text, or on the whole text. ``whole_parity`` compares whole texts.
Where the rebuilt pipeline gives other ids than the library, ``parity`` is false and the library's ids are returned.

Defined cases: null and empty texts have no ids and decode to the empty text; control pieces in a text are ordinary
characters; repeated rows are encoded alike; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

MARK = "▁"
#: Two noncharacters around the number of a piece that texts cannot reach.
HIDDEN = "\U0010ffff\U0010fffe"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
THREADS = 2
#: Text bytes that are encoded at a time, and words whose parity a task remembers.
SLICE_BYTES = 1_000_000
REMEMBERED_WORDS, LEARNT_AT_ONCE = 500_000, 65_536
#: New words that are encoded in a row.
RUN = 64
REPORT = "doc_id long, n_ids long, ids array<int>, round_trip boolean, parity boolean"


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and raw value of every field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, message[at : at + size]
        at += size


def read_model(message: bytes) -> dict:
    """The parts of a model file that encoding needs."""
    model = {"pieces": [], "kind": UNIGRAM, "charsmap": b"", "dummy_prefix": True, "extra_spaces": True}
    for number, value in fields(message):
        if number == 1:
            piece = dict(fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            model["pieces"].append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            model["kind"] = dict(fields(value)).get(3, UNIGRAM)
        elif number == 3:
            spec = dict(fields(value))
            model |= {"charsmap": spec.get(2, b""), "dummy_prefix": bool(spec.get(3, 1)), "extra_spaces": bool(spec.get(4, 1))}
    return model


def words_are_apart(model: dict) -> bool:
    """Whether no ordinary piece has the mark after another character."""
    return not any(MARK in piece.lstrip(MARK) for piece, _, kind in model["pieces"] if kind in (NORMAL, USER))


def merges(model: dict) -> list[tuple[str, str]]:
    """Pairs that make a piece, best piece first."""
    ids = {piece: i for i, (piece, _, kind) in enumerate(model["pieces"]) if kind in (NORMAL, USER)}
    found = []
    for piece, score, kind in model["pieces"]:
        if kind in (NORMAL, USER):
            splits = [(piece[:i], piece[i:]) for i in range(1, len(piece))]
            found += [(-score, ids[piece], ids[a], ids[b], a, b) for a, b in splits if a in ids and b in ids]
    return [(a, b) for *_, a, b in sorted(found)]


def build(message: bytes):
    """A tokenizers pipeline that encodes and decodes as the model does."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    model = read_model(message)
    pieces = model["pieces"]
    unknown = next(i for i, (_, _, kind) in enumerate(pieces) if kind == UNKNOWN)
    fallback = any(kind == BYTE for *_, kind in pieces)
    if model["kind"] == BPE:
        vocabulary = {piece: i for i, (piece, _, _) in enumerate(pieces)}
        core = models.BPE(vocabulary, merges(model), unk_token=pieces[unknown][0], fuse_unk=True, byte_fallback=fallback, cache_capacity=0)
    elif model["kind"] == UNIGRAM:
        # control, unused and unknown pieces keep their ids, but no text may spell them
        lattice = [(piece if kind in (NORMAL, USER, BYTE) else f"{HIDDEN}{i}{HIDDEN}", score) for i, (piece, score, kind) in enumerate(pieces)]
        core = models.Unigram(lattice, unknown, fallback)
    else:
        raise ValueError("only unigram and BPE models can be rebuilt")
    steps = [normalizers.Precompiled(model["charsmap"])] if model["charsmap"] else []
    if model["extra_spaces"]:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    steps += [normalizers.Prepend(MARK)] if model["dummy_prefix"] else []
    tokenizer = Tokenizer(core)
    tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    if words_are_apart(model):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    end = [decoders.Strip(" ", 1, 0)] if model["dummy_prefix"] else []
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *end])
    return tokenizer


class Encoder:
    """Encodes texts with both ends of the check: word by word where the model allows it, else whole texts."""

    def __init__(self, message: bytes, threads: int) -> None:
        import sentencepiece

        model = read_model(message)
        self.by_word = words_are_apart(model) and model["dummy_prefix"] and not (model["charsmap"] or model["extra_spaces"])
        self.tokenizer = build(message)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=message)
        self.threads = threads
        self.opens = np.array([piece.startswith(MARK) for piece, *_ in model["pieces"]])
        self.place: dict[str, int] = {}
        self.returned: set[str] = set()
        self.flat, self.ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.back, self.same = np.zeros(0, bool), np.zeros(0, bool)

    def batch(self, texts: list[str]) -> tuple[list[list[int]], list[bool], list[bool]]:
        """Ids, round trip and parity of each text. Where the library gives other ids, those are returned."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        theirs = self.library.encode(texts, num_threads=self.threads)
        same = [i == o for i, o in zip(ids, theirs, strict=True)]
        back = self.tokenizer.decode_batch(theirs, skip_special_tokens=False)
        return theirs, [t == b for t, b in zip(texts, back, strict=True)], same

    def words(self, text: str) -> list[str] | None:
        """The text's words, each with the spaces before it but one; None if it has to be encoded whole."""
        if not self.by_word or not text or text[-1] == " " or MARK in text:
            return None
        if text[0] != " " and "  " not in text:
            return text.split(" ")
        return [word[1:] for word in re.findall(" +[^ ]*", " " + text)]

    def look_up(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of remembered words, one after the other, and how many each has."""
        begin, sizes = self.ends[places], self.ends[places + 1] - self.ends[places]
        skipped = begin - (np.cumsum(sizes) - sizes)
        return self.flat[np.arange(sizes.sum()) + np.repeat(skipped, sizes)], sizes

    def forget(self) -> None:
        """Keeps the words that came back since the last time; none if that are too many."""
        kept = [word for word in self.place if word in self.returned] if len(self.returned) <= REMEMBERED_WORDS // 2 else []
        places = np.fromiter(map(self.place.__getitem__, kept), np.int64, len(kept))
        self.flat, sizes = self.look_up(places)
        self.ends = np.append(0, np.cumsum(sizes))
        self.back, self.same = self.back[places], self.same[places]
        self.place = {word: i for i, word in enumerate(kept)}
        self.returned = set()

    def one_by_one(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Ids, their number by word, round trip and parity by word."""
        ids, back, same = self.batch(words)
        return np.fromiter(chain.from_iterable(ids), np.int32), np.array([len(i) for i in ids], np.int64), np.array(back, bool), np.array(same, bool)

    def in_runs(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """The same for words without blanks, encoded many in a row; a run that fails a check is done word by word."""
        runs = [words[start : start + RUN] for start in range(0, len(words), RUN)]
        out = []
        for run, found, back, same in zip(runs, *self.batch([" ".join(run) for run in runs]), strict=True):
            found = np.array(found, np.int32)
            sizes = np.diff(np.append(np.flatnonzero(self.opens[found]), len(found)))
            if back and same and len(sizes) == len(run) and sizes.sum() == len(found):
                out.append((found, sizes, np.ones(len(run), bool), np.ones(len(run), bool)))
            else:
                out.append(self.one_by_one(run))
        return tuple(map(np.concatenate, zip(*out, strict=True)))

    def learn(self, words: set[str]) -> None:
        if len(self.place) > REMEMBERED_WORDS:
            self.forget()
        fresh = [word for word in words if word not in self.place]
        self.returned |= words.difference(fresh)
        plain = [word for word in fresh if word and word[0] != " "]
        rest = [word for word in fresh if not word or word[0] == " "]
        found = [self.in_runs(plain[start : start + LEARNT_AT_ONCE]) for start in range(0, len(plain), LEARNT_AT_ONCE)]
        found += [self.one_by_one(rest)] if rest else []
        if found:
            ids, sizes, back, same = map(np.concatenate, zip(*found, strict=True))
            self.place.update(zip(chain(plain, rest), range(len(self.place), len(self.place) + len(fresh)), strict=True))
            self.flat = np.append(self.flat, ids)
            self.ends = np.append(self.ends, self.ends[-1] + np.cumsum(sizes))
            self.back, self.same = np.append(self.back, back), np.append(self.same, same)

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[bool], list[bool]]:
        cut = [self.words(t) for t in texts]
        self.learn(set().union(*(c for c in cut if c)))
        whole = zip(*self.batch([t for t, c in zip(texts, cut, strict=True) if c is None]), strict=True)
        ids, back, same = [], [], []
        for words in cut:
            if words is None:
                found, b, s = next(whole)
                found = np.array(found, np.int32)
            else:
                places = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
                found, _ = self.look_up(places)
                b, s = bool(self.back[places].all()), bool(self.same[places].all())
            ids.append(found)
            back.append(b)
            same.append(s)
        return ids, back, same


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    size = start = 0
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
    for end, more in enumerate(sizes):
        if size and size + more > SLICE_BYTES:
            yield batch.slice(start, end - start)
            start, size = end, 0
        size += more
    if batch.num_rows:
        yield batch.slice(start)


def _encode(batches: Iterator[pa.RecordBatch], message: bytes, threads: int) -> Iterator[pa.RecordBatch]:
    os.environ["RAYON_NUM_THREADS"] = str(threads)
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    encoder = Encoder(message, threads)
    for batch in batches:
        for part in _slices(batch):
            ids, back, same = encoder.encode([t or "" for t in part.column("text").to_pylist()])
            ends = np.cumsum([0, *map(len, ids)])
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate(ids)))
            columns = [part.column("doc_id"), pa.array(np.diff(ends)), lists, pa.array(back), pa.array(same)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_ids", "ids", "round_trip", "parity"])


def encode(documents: DataFrame, model_path: str, threads: int = THREADS) -> DataFrame:
    """Ids of every text, whether they decode to the text, and whether sentencepiece gives the same."""
    with open(model_path, "rb") as file:
        message = file.read()
    return documents.select("doc_id", "text").mapInArrow(lambda b: _encode(b, message, threads), REPORT)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    with open(model_path, "rb") as file:
        message = file.read()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = build(message)
        for batch in batches:
            found = tokenizer.decode_batch([i or [] for i in batch.column("ids").to_pylist()], skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(texts, "doc_id long, text string")


def whole_parity(texts: list[str], model_path: str) -> list[bool]:
    """Whether both libraries give the same ids, text by text."""
    import sentencepiece

    with open(model_path, "rb") as file:
        message = file.read()
    library = sentencepiece.SentencePieceProcessor(model_proto=message)
    ours = build(message).encode_batch_fast(texts, add_special_tokens=False)
    return [a.ids == b for a, b in zip(ours, library.encode(texts), strict=True)]
