"""A hidden Markov language model over whole texts.

Tokens are lower-cased words and one end token. Latent states emit word classes: each of the most frequent words is a
class of its own, all other words fall into hashed classes, and within a class a word has its smoothed share,
whatever the state. The sequence likelihood is then exact: the scaled forward recursion over the classes, times the
shares. The counts behind the shares grow with the corpus and stay in a table; only the class-by-state matrix (bounded
by the parameters) and a bounded list of frequent words travel to the tasks, rarer words are joined.

Training is Baum-Welch: tasks run forward and backward passes over windows of all training texts and return expected
counts, which are summed per class; a window starts from the states' stationary shares. Scoring runs over whole texts:
long ones are cut into stretches that are carried as state-by-state matrices and multiplied in order, so one text
never makes a long chain of single steps.

Defined cases: null text counts as empty and has the end token alone; a null doc_id counts as the empty text for the
split; repeated rows are texts of their own; without training rows every token has probability 1 by the base formula
and the model is uniform over its classes; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_remainder, few_rows, slices, stage_table, texts

STATES, ROUNDS, SEED = 6, 4, 11
OWN_CLASSES, HASHED_CLASSES = 8_192, 1_024
#: Words that tasks look up without a join, at most: all those of some count or more.
LISTED_WORDS = 131_072
END = OWN_CLASSES + HASHED_CLASSES
CLASSES = END + 1
WINDOW, WINDOWS = 64, 1_024
STRETCH = 2_048
COUNTED_WORDS = 400_000
#: Weight of the states' common distribution in each state's emissions, in tokens.
PRIOR = 50.0


@dataclass
class Vocabulary:
    """Totals, the listed words with their counts (most frequent first), and counts of the hashed classes."""

    tokens: int
    distinct: int
    ends: int
    words: list[bytes]
    counts: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray


@dataclass
class Model:
    start: np.ndarray
    moves: np.ndarray
    emissions: np.ndarray


class _Places(dict):
    """Word to its place in the list; -1 for others."""

    def __missing__(self, word: bytes) -> int:
        return -1


def count_words(documents: DataFrame) -> DataFrame:
    """(word, n) over ``text``; blanks separate words, A-Z count as a-z."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def rows() -> pa.RecordBatch:
            words = pa.array(list(found), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(found.values()), pa.int64())], ["word", "n"])

        for batch in slices(batches, "text"):
            for text in texts(batch.column("text")):
                found.update(text.lower().split())
            if len(found) > COUNTED_WORDS:
                yield rows()
                found.clear()
        yield rows()

    return documents.select("text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _class_of(word: bytes) -> int:
    return OWN_CLASSES + crc32(word) % HASHED_CLASSES


def vocabulary(counts: DataFrame, ends: int) -> tuple[Vocabulary, DataFrame]:
    """The bounded part of a staged word count, and the rest of it as a table."""
    sizes = counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).take(LISTED_WORDS)
    least, listed = math.inf, 0
    for row in sizes:
        listed += row.words
        if listed > LISTED_WORDS:
            break
        least = row.n
    listed = sorted(few_rows(counts.where(F.col("n") >= least), LISTED_WORDS) if sizes and least < math.inf else [], key=lambda r: (-r.n, r.word))
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("words")).first()
    kept = [(r.word,) for r in listed]
    session = counts.sparkSession
    own = F.broadcast(session.createDataFrame(kept[:OWN_CLASSES], "word string"))
    rest = counts.join(own, "word", "left_anti").groupBy((F.crc32("word") % HASHED_CLASSES).alias("place"))
    class_tokens, class_words = np.zeros(HASHED_CLASSES, np.int64), np.zeros(HASHED_CLASSES, np.int64)
    for r in few_rows(rest.agg(F.sum("n").alias("n"), F.count("*").alias("words")), HASHED_CLASSES):
        class_tokens[r.place], class_words[r.place] = r.n, r.words
    unlisted = counts.join(F.broadcast(session.createDataFrame(kept, "word string")), "word", "left_anti")
    known = Vocabulary(
        (total.n or 0) + ends, total.words + (ends > 0), ends, [r.word.encode() for r in listed], np.array([r.n for r in listed], np.int64), class_tokens, class_words
    )
    return known, unlisted


def base_log(counts: np.ndarray | int, known: Vocabulary) -> np.ndarray:
    return np.log10((np.asarray(counts) + 1) / (known.tokens + known.distinct + 1))


def encode(documents: DataFrame, known: Vocabulary) -> DataFrame:
    """Per row: key, token counts, sums over listed words, class sequence (int32 bytes), and its other words with counts."""
    place = _Places((word, i) for i, word in enumerate(known.words))
    classes = np.array([i if i < OWN_CLASSES else _class_of(w) for i, w in enumerate(known.words)] + [0], np.int32)
    hashed = np.maximum(classes[:-1] - OWN_CLASSES, 0)
    share = np.log10((known.counts + 1) / (known.class_tokens[hashed] + known.class_words[hashed] + 1))
    share = np.append(np.where(classes[:-1] < OWN_CLASSES, 0.0, share), 0.0)
    base = np.append(base_log(known.counts, known), 0.0)
    end = float(base_log(known.ends, known))
    ends_known = int(known.ends > 0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 40
        for batch in slices(batches, "text"):
            out: list[list] = [[] for _ in range(8)]
            for text in texts(batch.column("text")):
                words = text.lower().split()
                found = np.fromiter(map(place.__getitem__, words), np.int32, len(words))
                sequence = np.append(classes[found], np.int32(END))
                missing = np.flatnonzero(found < 0)
                other: Counter = Counter(words[i] for i in missing.tolist())
                if other:
                    sequence[missing] = [_class_of(words[i]) for i in missing.tolist()]
                row = (key, len(words) + 1, len(words) - len(missing) + ends_known, math.fsum(base[found]) + end, math.fsum(share[found]))
                for column, value in zip(out, (*row, sequence.tobytes(), list(other), list(other.values())), strict=True):
                    column.append(value)
                key += 1
            words = pa.array(out[6], pa.list_(pa.binary())).cast(pa.list_(pa.string()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(out, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *arrays, words, pa.array(out[7], pa.list_(pa.int32()))],
                ["doc_id", "held_out", "key", "n_tokens", "n_listed", "listed_base", "listed_share", "classes", "others", "times"],
            )

    kinds = "doc_id long, held_out boolean, key long, n_tokens long, n_listed long, listed_base double, listed_share double, classes binary, others array<string>, times array<int>"
    return documents.select("doc_id", "text", "held_out").mapInArrow(work, kinds)


def first_model(frequencies: np.ndarray, states: int = STATES) -> Model:
    """A fixed random start: states that tend to stay, each with its own emphasis on the classes."""
    chance = np.random.default_rng(SEED)
    common = (frequencies + 1) / (frequencies.sum() + len(frequencies))
    emissions = common[:, None] * chance.gamma(1.0, size=(len(frequencies), states))
    moves = np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    return Model(np.full(states, 1 / states), moves, emissions / emissions.sum(0))


def expected(windows: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions over windows (time by window, -1 pads the end), and their log likelihood."""
    length, many = windows.shape
    states = len(model.start)
    table = np.hstack([model.emissions.T, np.ones((states, 1))]).astype(np.float32)
    onward, back = model.moves.T.astype(np.float32).copy(), model.moves.astype(np.float32)
    inside = (windows >= 0).astype(np.float32)
    seen = np.empty((length, states, many), np.float32)
    ahead = np.empty_like(seen)
    scale = np.empty((length, many), np.float32)
    now = np.repeat(model.start.astype(np.float32)[:, None], many, axis=1)
    for t in range(length):
        np.take(table, windows[t], axis=1, out=seen[t], mode="wrap")
        now = (onward @ now if t else now) * seen[t]
        scale[t] = np.maximum(now.sum(0), 1e-30)
        now /= scale[t]
        ahead[t] = now
    behind = np.ones((states, many), np.float32)
    pairs = np.zeros((states, states))
    weights = np.empty_like(ahead)
    for t in range(length - 1, -1, -1):
        np.multiply(ahead[t], behind, out=weights[t])
        weights[t] *= inside[t]
        if t:
            later = behind * seen[t]
            later /= scale[t]
            pairs += ahead[t - 1] @ (later * inside[t]).T
            behind = back @ later
    flat, counts = windows.ravel() + 1, np.empty((CLASSES, states))
    for state in range(states):
        counts[:, state] = np.bincount(flat, weights[:, state].ravel(), CLASSES + 1)[1:]
    return weights[0].sum(1), pairs * model.moves, counts, float((np.log(scale) * inside).sum())


def _windows(rows: list[bytes]) -> Iterator[np.ndarray]:
    """Groups of windows of the rows' class sequences."""
    flat = np.concatenate([np.frombuffer(r, np.int32) for r in rows])
    sizes = np.array([len(r) // 4 for r in rows])
    many = -(-sizes // WINDOW)
    total = int(many.sum())
    first = np.cumsum(sizes) - sizes
    within = np.arange(total) - np.repeat(np.cumsum(many) - many, many)
    starts = np.repeat(first, many) + within * WINDOW
    left = np.minimum(np.repeat(sizes, many) - within * WINDOW, WINDOW)
    step = np.arange(WINDOW)
    for at in range(0, total, WINDOWS):
        places = starts[at : at + WINDOWS, None] + step
        valid = step < left[at : at + WINDOWS, None]
        yield np.where(valid, flat[np.minimum(places, len(flat) - 1)], -1).T


def baum_welch(encoded: DataFrame, rounds: int = ROUNDS, states: int = STATES) -> tuple[Model, list[float]]:
    """The trained model and the log likelihood of the windows before each round."""
    rows = encoded.where("NOT held_out").select("classes")

    def counts(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
        width = states if model else 1
        total, head, likelihood = np.zeros((CLASSES, width)), np.zeros((states + 1, states)), 0.0
        for batch in batches:
            column = batch.column("classes")
            for at in range(0, len(column), 2_048):
                part = column.slice(at, 2_048).to_pylist()
                if model is None:
                    total[:, 0] += np.bincount(np.frombuffer(b"".join(part), np.int32), minlength=CLASSES)
                    continue
                for windows in _windows(part):
                    starts, pairs, found, value = expected(windows, model)
                    head[0] += starts
                    head[1:] += pairs
                    total += found
                    likelihood += value
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(total[used, k]) for k in range(width))], ["place", *(f"c{k}" for k in range(width))])
        if model is not None:
            extra = np.vstack([head, np.full(states, likelihood / states)])
            places = CLASSES + np.arange(len(extra))
            yield pa.RecordBatch.from_arrays([pa.array(places), *(pa.array(extra[:, k]) for k in range(width))], ["place", *(f"c{k}" for k in range(width))])

    def gather(model: Model | None) -> np.ndarray:
        width = states if model else 1
        names = [f"c{k}" for k in range(width)]
        parts = rows.mapInArrow(lambda b: counts(b, model), "place long, " + ", ".join(f"{n} double" for n in names))
        out = np.zeros((CLASSES + states + 2, width))
        for r in few_rows(parts.groupBy("place").agg(*[F.sum(n).alias(n) for n in names]), len(out)):
            out[r.place] = r[1:]
        return out

    frequencies = gather(None)[:CLASSES, 0]
    model, history = first_model(frequencies, states), []
    common = (frequencies + 1) / (frequencies.sum() + CLASSES)
    for _ in range(rounds if frequencies.any() else 0):
        found = gather(model)
        history.append(float(found[-1].sum()))
        emissions = found[:CLASSES] + PRIOR * common[:, None]
        moves = found[CLASSES + 1 : CLASSES + 1 + states] + 1.0
        start = found[CLASSES] + 1.0
        model = Model(start / start.sum(), moves / moves.sum(1, keepdims=True), emissions / emissions.sum(0))
    return model, history


def sequence_logs(rows: list[bytes], model: Model, stretch: int = STRETCH) -> np.ndarray:
    """log10 likelihood of each class sequence, by the scaled forward recursion."""
    states = len(model.start)
    flat = np.concatenate([np.frombuffer(r, np.int32) for r in rows])
    sizes = np.array([len(r) // 4 for r in rows])
    first = np.cumsum(sizes) - sizes
    owner, begin, length, opening = [], [], [], []
    for i, (at, size) in enumerate(zip(first.tolist(), sizes.tolist(), strict=True)):
        for cut in range(0, size, stretch):
            vectors = [model.start] if cut == 0 else model.moves
            for vector in vectors:
                owner.append(i)
                begin.append(at + cut)
                length.append(min(stretch, size - cut))
                opening.append(vector)
    length = np.array(length)
    order = np.argsort(-length, kind="stable")
    begin, now = np.array(begin)[order], np.array(opening).T[:, order]
    active = np.searchsorted(-length[order], -np.arange(length.max()), side="left")
    table, onward = model.emissions.T.copy(), model.moves.T.copy()
    logs, ended = np.zeros(len(order)), np.empty_like(now)
    for t, live in enumerate(active.tolist()):
        if live < now.shape[1]:
            ended[:, live : now.shape[1]] = now[:, live:]
            now = now[:, :live]
        now = (onward @ now if t else now) * np.take(table, flat[begin[:live] + t], axis=1)
        scale = now.sum(0)
        now /= scale
        logs[:live] += np.log10(scale)
    ended[:, : now.shape[1]] = now
    final, sums = np.empty(ended.T.shape), np.empty_like(logs)
    final[order], sums[order] = ended.T, logs
    out, at = np.empty(len(rows)), 0
    for i, size in enumerate(sizes.tolist()):
        vector, total = final[at], sums[at]
        at += 1
        for _ in range(-(-size // stretch) - 1):
            part, scale = final[at : at + states], sums[at : at + states]
            top = scale.max()
            vector = (vector * 10 ** (scale - top)) @ part
            total += top + math.log10(vector.sum())
            vector = vector / vector.sum()
            at += states
        out[i] = total
    return out


def _forward(encoded: DataFrame, model: Model) -> DataFrame:
    names = ["doc_id", "held_out", "key", "n_tokens", "n_listed", "listed_base", "listed_share"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4_096):
                part = batch.slice(at, 4_096)
                found = sequence_logs(part.column("classes").to_pylist(), model)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(found)], [*names, "sequence"])

    kinds = "doc_id long, held_out boolean, key long, n_tokens long, n_listed long, listed_base double, listed_share double, sequence double"
    return encoded.select(*names, "classes").mapInArrow(work, kinds)


def score(documents: DataFrame, modulus: int = 7, held: int = 2, rounds: int = ROUNDS, states: int = STATES) -> tuple[DataFrame, list[float]]:
    """Scores of all documents by a model that learns from those whose crc32 remainder is not ``held``; and its history."""
    rows = documents.select("doc_id", "text", (crc_remainder("doc_id", modulus) == held).alias("held_out"))
    training = rows.where("NOT held_out")
    counts = stage_table(count_words(training), "words")
    known, unlisted = vocabulary(counts, training.count())
    encoded = stage_table(encode(rows, known), "encoded")
    model, history = baum_welch(encoded, rounds, states)
    session = documents.sparkSession
    table = [(i, int(a), int(b)) for i, (a, b) in enumerate(zip(known.class_tokens, known.class_words, strict=True))]
    classes = F.broadcast(session.createDataFrame(table, "place long, class_tokens long, class_words long"))
    others = encoded.select("key", F.explode(F.arrays_zip("others", "times")).alias("x")).select("key", F.col("x.others").alias("word"), F.col("x.times").alias("times"))
    joined = others.join(unlisted, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    joined = joined.withColumn("place", F.crc32("word") % HASHED_CLASSES).join(classes, "place")
    below = known.tokens + known.distinct + 1
    rest = joined.groupBy("key").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times"))).alias("more_known"),
        F.sum(F.col("times") * F.log10((F.col("n") + 1) / F.lit(below))).alias("more_base"),
        F.sum(F.col("times") * F.log10((F.col("n") + 1) / (F.col("class_tokens") + F.col("class_words") + 1))).alias("more_share"),
    )
    whole = _forward(encoded, model).join(rest, "key", "left")
    found = whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_listed") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("listed_base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("sequence") + F.col("listed_share") + F.coalesce("more_share", F.lit(0.0))).alias("score"),
    )
    return found, history
