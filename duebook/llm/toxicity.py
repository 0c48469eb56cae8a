"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The features of a text: how dense words of a lexicon are (over the text, in the densest stretch of fifty words, and how
many distinct ones), how near they stand to the second person, the share of capitals, punctuation and digits, runs of
marks, obfuscated words (a letter between signs or digits, a letter said three times), and lexicon words after undoing
common substitutions. The lexicon is learnt from the labelled training texts: words whose log odds of
a toxic document stand clear of zero, less their sampling error. Trees are trained on three quarters of the labelled training rows; the
rest, unseen by lexicon and trees, calibrates their margin by isotonic regression.

Labelled rows are a bounded sample (about ``labelled_limit``, by hash); every document is scored on its whole text.

Defined cases: null text counts as empty, whose features are all zero; rows are scored alone, so repeated rows and ties
get equal scores; with no labels, or of one class only, every score is that class's share (0.5 with none); labels,
language, source and doc_id are no features; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_remainder, few_rows, labelled_sample, slices, stage_table, texts

LABELLED_LIMIT = 20_000
LEXICON_SIZE, LEAST_DOCUMENTS, LEAST_ODDS = 400, 3, 0.8
TREES, DEPTH, LEARNING = 24, 4, 0.2
STRETCH, NEAR = 50, 6
#: The second person in the four languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen euch euer ihr tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split()
)
#: Signs that stand for letters.
SUBSTITUTES = str.maketrans("013457@$!|", "oieastasil")
LETTER = re.compile(r"[^\W_]")
REPEATED = re.compile(r"([^\W\d_])\1\1")
INNER = re.compile(r"[^\W\d_][\d@$!*|+#]+[^\W\d_]")
RUNS = re.compile(r"[!?]{2,}")
FEATURES = (
    "density", "peak", "distinct", "near_person", "person", "hidden", "capitals", "loud_words", "punctuation", "runs", "digits", "repeated", "inner", "length",
)


def bare(word: str) -> str:
    """A word in lower case, without signs around it."""
    word = word.lower()
    if word.isalnum():
        return word
    first, last = LETTER.search(word), LETTER.search(word[::-1])
    return word[first.start() : len(word) - last.start()] if first else ""


def near_any(hits: list[int], persons: list[int]) -> int:
    """Hits with a second person at most ``NEAR`` words away; both lists ascend."""
    if not hits or not persons:
        return 0
    at, others = np.array(hits), np.array(persons)
    after = np.searchsorted(others, at)
    left, right = others[np.maximum(after - 1, 0)], others[np.minimum(after, len(others) - 1)]
    return int(((np.abs(at - left) <= NEAR) | (np.abs(right - at) <= NEAR)).sum())


def features(text: str, lexicon: frozenset[str]) -> list[float]:
    raw = text.split()
    if not raw:
        return [0.0] * len(FEATURES)
    words = [bare(w) for w in raw]
    n, letters = len(words), max(1, sum(map(str.isalpha, text)))
    hits = [i for i, w in enumerate(words) if w in lexicon]
    persons = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    odd = [w for w in raw if not w.isalpha()]
    inner = [w for w in odd if INNER.search(w)]
    hidden = sum(bare(w.translate(SUBSTITUTES)) in lexicon for w in inner)
    near = near_any(hits, persons)
    places = np.array(hits)
    peak = int((np.searchsorted(places, places + STRETCH) - np.arange(len(hits))).max()) if hits else 0
    loud = sum(len(w) > 2 and w.isupper() for w in raw)
    signs = sum(map(text.count, "!?.,;:*#$%&"))
    return [
        len(hits) / n, float(peak), float(len({words[i] for i in hits})), near / n, len(persons) / n, float(hidden), sum(map(str.isupper, text)) / letters, loud / n,
        signs / len(text), len(RUNS.findall(text)) / n, sum(map(str.isdigit, text)) / len(text), len(REPEATED.findall(text)) / n, len(inner) / n, math.log1p(n),
    ]


def learn_lexicon(rows: DataFrame) -> frozenset[str]:
    """Words (text, toxic) that mark toxic documents; counted per document over the bounded labelled rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[int]] = {}
        for batch in slices(batches, "text"):
            for text, toxic in zip(texts(batch.column("text")), batch.column("toxic").to_pylist(), strict=True):
                for word in {bare(w) for w in text.decode().split()}:
                    found.setdefault(word, [0, 0])[toxic] += 1
        words = list(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([found[w][0] for w in words], pa.int64()), pa.array([found[w][1] for w in words], pa.int64())], ["word", "clean", "toxic"]
        )

    sizes = {r.toxic: r["count"] for r in few_rows(rows.groupBy("toxic").count(), 2)}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    counts = rows.mapInArrow(count, "word string, clean long, toxic long").groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    odds = odds - 1.64 * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    marked = counts.where(F.length("word") > 1).where(F.col("toxic") >= LEAST_DOCUMENTS).withColumn("odds", odds).where(F.col("odds") >= LEAST_ODDS)
    weight = F.col("odds") * F.sqrt("toxic")
    return frozenset(r.word for r in marked.orderBy(weight.desc(), "word").select("word").take(LEXICON_SIZE))


def with_features(rows: DataFrame, lexicon: frozenset[str]) -> DataFrame:
    """The rows without text, with one column per feature."""
    kept = [c for c in rows.columns if c != "text"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.array([features(t.decode(), lexicon) for t in texts(batch.column("text"))])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(found[:, i]) for i in range(len(FEATURES)))], [*kept, *FEATURES])

    kinds = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept), *(f"{f} double" for f in FEATURES)])
    return rows.mapInArrow(work, kinds)


def score(documents: DataFrame, labels: DataFrame, modulus: int = 5, held: int = 0, labelled_limit: int = LABELLED_LIMIT) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; labels of held-out documents are never read."""
    usable = labels.where("toxic IN (0, 1)").where(crc_remainder("doc_id", modulus) != held)
    sample = labelled_sample(usable, ["toxic"], labelled_limit).select(F.col("doc_id").alias("labelled_id"), F.col("toxic").cast("int").alias("toxic"))
    rows = documents.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("labelled_id"))
    staged = stage_table(rows.select("text", "toxic", (F.crc32(F.concat(F.lit("part:"), F.col("doc_id").cast("string"))) % 4 == 0).alias("calibrates")), "labelled")
    lexicon = learn_lexicon(staged.where("NOT calibrates").select("text", "toxic"))
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    known = stage_table(with_features(staged, lexicon), "features")
    classes = {(r.calibrates, r.toxic): r["count"] for r in few_rows(known.groupBy("calibrates", "toxic").count(), 4)}
    held_out = (crc_remainder("doc_id", modulus) == held).alias("held_out")
    wide = with_features(documents.select("doc_id", "text", held_out), lexicon)
    if not (classes.get((False, 0)) and classes.get((False, 1))):
        total = sum(classes.values())
        share = sum(n for (_, toxic), n in classes.items() if toxic) / total if total else 0.5
        return wide.select("doc_id", "held_out", F.lit(share).alias("score"), F.lit(int(share >= 0.5)).alias("predicted"))
    trees = GBTClassifier(labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=LEARNING, seed=7, minInstancesPerNode=5, cacheNodeIds=False)
    model = trees.fit(assembler.transform(known.where("NOT calibrates").coalesce(1)))
    margin = vector_to_array("rawPrediction")[1]
    calibration = model.transform(assembler.transform(known.where("calibrates" if classes.get((True, 1)) and classes.get((True, 0)) else "true")))
    curve = IsotonicRegression(labelCol="toxic", featuresCol="margin", predictionCol="score").fit(calibration.select(F.col("toxic").cast("double"), margin.alias("margin")).coalesce(1))
    scored = model.transform(assembler.transform(wide)).select("doc_id", "held_out", margin.alias("margin"))
    scored = curve.transform(scored).select("doc_id", "held_out", F.least(F.lit(1.0), F.greatest(F.lit(0.0), "score")).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int"))
