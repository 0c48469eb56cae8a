"""Quality rules: a hashed n-gram log-likelihood ratio between trusted and raw text, beside fixed counts.

Words and word pairs are hashed into buckets. One multinomial is counted over every document (raw), one over documents
labelled as good (trusted). A document's score is the mean log ratio of the two over its n-grams, and every document
whose score reaches one fixed threshold is kept. The threshold comes from labelled documents that the trusted counts
have not seen: the one of best balanced accuracy.

Every labelled row is used: good ones of one half (by hash) are counted, all of the other half set the threshold. Texts are
counted and scored where they are read, and only their ids, counts and scores meet the labels in shuffles; the threshold
comes from running totals over the distinct scores.

Defined cases: a null or blank text has no words and fails the fixed rules; rows are judged one by one, so repeated
rows get the same verdict and ties at the threshold are kept; without good labels no document fails the method; without
bad ones the threshold is the lowest score of a good one; texts that share a labelled doc_id set the threshold by their
lowest score; other columns pass through ``keep_documents`` untouched and are ignored elsewhere; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.operators.ordering import add_slots, cut_points, running_totals, slot_count

from .common import few_cells, key_filter, rows_with, slices, stage_table, texts

BUCKETS = 65_536
#: Weight of the raw distribution in the trusted one, in n-grams.
PRIOR = 65_536.0
MULTIPLIER = 31
REMEMBERED_WORDS = 200_000
SYMBOLS = b"#*$%&|<>"
DECIMALS = 9
REPORT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, score double, kept boolean"
)


class _Words(dict):
    """Word to the first 48 bits of its MD5, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = self[word] = int(md5(word).hexdigest()[:12], 16)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def ngram_buckets(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of every word and of every pair of neighbours."""
    return np.concatenate([hashes, hashes[:-1] * MULTIPLIER + hashes[1:]]) % buckets


def repeated_words(hashes: np.ndarray) -> int:
    """Words inside three-word windows that occur at least twice."""
    if len(hashes) < 4:
        return 0
    h = hashes.astype(np.uint64)
    keys = (h[:-2] * np.uint64(0x9E3779B97F4A7C15) + h[1:-1]) * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(h), bool)
    for shift in range(3):
        covered[shift : shift + len(keys)] |= twice
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    seen: set[bytes] = set()
    found = 0
    for line in text.split(b"\n"):
        if line in seen:
            found += 1
        elif line.strip():
            seen.add(line)
    return found


def _counts(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    words, counts = _Words(), np.zeros(buckets, np.int64)
    for batch in slices(batches, "text"):
        for text in texts(batch.column("text")):
            if tokens := text.split():
                counts += np.bincount(ngram_buckets(words.of(tokens), buckets), minlength=buckets)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])


def bucket_counts(documents: DataFrame, buckets: int) -> np.ndarray:
    found = documents.select("text").mapInArrow(lambda b: _counts(b, buckets), "bucket long, n long")
    counts = np.zeros(buckets)
    for row in few_cells(found.groupBy("bucket").agg(F.sum("n").alias("n")), [], "bucket", "n", buckets):
        counts[row.bucket] = row.n
    return counts


def fit_ratios(documents: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Log ratio per bucket of the ``trusted`` texts against all. All zero where nothing is trusted."""
    good = bucket_counts(trusted, buckets)
    if not good.sum():
        return np.zeros(buckets)
    raw = bucket_counts(documents, buckets)
    background = (raw + 1) / (raw.sum() + buckets)
    return np.log((good + PRIOR * background) / (good.sum() + PRIOR) / background)


def mean_ratio(hashes: np.ndarray, ratios: np.ndarray) -> float:
    if not len(hashes):
        return 0.0
    found = ngram_buckets(hashes, len(ratios))
    return round(math.fsum(ratios[found]) / len(found), DECIMALS)


def _report(batches: Iterator[pa.RecordBatch], ratios: np.ndarray, threshold: float) -> Iterator[pa.RecordBatch]:
    words, schema = _Words(), None
    for batch in slices(batches, "text"):
        columns: list[list] = [[] for _ in range(8)]
        points = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
        for text, length in zip(texts(batch.column("text")), points, strict=True):
            tokens = text.split()
            hashes = words.of(tokens)
            repeats, score = repeated_words(hashes), mean_ratio(hashes, ratios)
            blanks = sum(text.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
            failed = len(tokens) < 50 or 100 * repeats > 50 * len(tokens)
            row = (len(tokens), length - blanks, sum(map(text.count, SYMBOLS)), repeated_lines(text), repeats, failed, score)
            for column, value in zip(columns, (*row, not failed and score >= threshold), strict=True):
                column.append(value)
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
        schema = schema or pa.schema([("doc_id", pa.int64()), *zip(names, kinds, strict=True)])
        arrays = [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def choose_threshold(scored: list[tuple[float, int]]) -> float:
    """The cut of best balanced accuracy over (score, label), the lowest if several: midway to the next lower score."""
    good = sorted(s for s, label in scored if label == 1)
    bad = sorted(s for s, label in scored if label == 0)
    if not good:
        return -math.inf
    if not bad:
        return good[0]
    cuts = np.array(sorted({*good, *bad}))
    kept = 1 - np.searchsorted(good, cuts) / len(good)
    passed = 1 - np.searchsorted(bad, cuts) / len(bad)
    best = int(np.argmax(np.round(kept - passed, 12)))
    return float(cuts[best] if best == 0 else (cuts[best - 1] + cuts[best]) / 2)


def fit_threshold(scored: DataFrame) -> float:
    """``choose_threshold`` over rows (score, quality) of any number."""
    each = [F.count_if(F.col("quality") == label).alias(name) for label, name in ((1, "good"), (0, "bad"))]
    counts = stage_table(scored.groupBy("score").agg(*each), "scores")
    whole = counts.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.min(F.when(F.col("good") > 0, F.col("score"))).alias("low"), F.count("*").alias("n")).first()
    if not whole.good:
        return -math.inf
    if not whole.bad:
        return whole.low
    slotted = add_slots(counts, cut_points(counts, {"score": slot_count(counts, whole.n)}))
    upto = running_totals(slotted, [], ["score_slot"], ["score"], {"good_upto": "good", "bad_upto": "bad"})
    # Good and bad documents below a cut, each as a share of its kind, times both totals: whole numbers, so ties are exact.
    below = [(F.col(f"{name}_upto") - F.col(name)).cast("decimal(19,0)") for name in ("good", "bad")]
    gain = below[1] * F.lit(whole.good).cast("decimal(18,0)") - below[0] * F.lit(whole.bad).cast("decimal(18,0)")
    cut = -upto.agg(F.max(F.struct(gain.alias("gain"), (-F.col("score")).alias("minus"))).alias("best")).first().best.minus
    lower = counts.where(F.col("score") < cut).agg(F.max("score").alias("score")).first().score
    return cut if lower is None else (lower + cut) / 2


def counted(doc_id: Column) -> Column:
    """Whether a labelled document is one that is counted if good (or else one that sets the threshold); half of them, by hash."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("part:"), doc_id.cast("string"))), 1, 2), 16, 10).cast("int") % 2 == 0


def fit(documents: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, float]:
    """Bucket ratios and threshold. Good documents of one half of the labelled ones are counted, the other half sets the cut."""
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    known = known.withColumn("counted", counted(F.col("doc_id"))).where("quality = 1 OR NOT counted")
    known = stage_table(known, "known")
    narrow = documents.select("doc_id", "text")
    ratios = fit_ratios(documents, rows_with(narrow, known.where("counted").select("doc_id")), buckets)
    if not ratios.any():
        return ratios, -math.inf
    held = known.where("NOT counted")
    likely = narrow.where(key_filter(held.select("doc_id"))(F.col("doc_id")))
    passed = report(likely, ratios, -math.inf).where("NOT base_failed").select("doc_id", "score").join(held, "doc_id")
    lowest = passed.groupBy("doc_id", "quality").agg(F.min("score").alias("score"))
    return ratios, fit_threshold(lowest.select("score", "quality"))


def report(documents: DataFrame, ratios: np.ndarray, threshold: float) -> DataFrame:
    """Counts, score and verdict of every document."""
    return documents.select("doc_id", "text").mapInArrow(lambda b: _report(b, ratios, threshold), REPORT)


def keep_documents(documents: DataFrame, ratios: np.ndarray, threshold: float) -> DataFrame:
    """The documents that the rules keep, with all their columns."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            narrow = batch.select(["doc_id", "text"])
            verdicts = pa.concat_arrays([b.column("kept") for b in _report(iter([narrow]), ratios, threshold)] or [pa.array([], pa.bool_())])
            yield batch.filter(verdicts)

    return documents.mapInArrow(kept, documents.schema)
