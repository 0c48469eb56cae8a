"""Soft-membership mixing: every document belongs to the domains in parts, and gets a rate so that totals hit targets.

A naive-Bayes classifier over hashed words, learnt from a bounded table of labelled documents, gives posteriors for each
window of words; their mean, weighted by length, is the document's membership. With n tokens and membership p, a
document adds rate * n * p[d] expected tokens to domain d. Rates solve a nonnegative least-squares problem (relative
misses of the domain totals, and a weak pull to rate 1) by accelerated projected gradient. Each step needs only the
domain totals, one distributed sum; a document's rate is a function of its membership and the short list of past
gradients, so rates are replayed wherever they are needed, and no state is kept or joined.

Labelled rows are a bounded sample (about ``labelled_limit``, by hash); memberships, totals and rates cover all rows.

Defined cases: a null or blank text has no tokens, membership by the prior, and weighs nothing in the totals; without
labelled rows there is one domain, so one rate; repeated rows are documents of their own with equal rates; a target of
zero drives a domain's documents to the floor; a domain without tokens is left out of the fit; an empty table gives an
empty result; other columns pass through ``remix`` untouched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import few_cells, few_rows, labelled_sample, slices, stage_table, texts

BUCKETS = 32_768
LABELLED_LIMIT = 20_000
#: Domains at most; more raise an error, as their word counts would not fit the driver.
MAX_DOMAINS = 256
WINDOW = 64
REMEMBERED_WORDS = 200_000
#: Exponent that flattens the found shares into default targets.
FLATTEN = 0.7
PULL = 1e-4
STEPS, TOLERANCE = 60, 1e-4
RATES = "doc_id long, n_tokens long, membership array<double>, rate double, copies long"


@dataclass
class Classifier:
    domains: list[str]
    logs: np.ndarray
    prior: np.ndarray


@dataclass
class Plan:
    """What turns a membership into a rate: the step size and the gradient of each step."""

    step: float
    floor: float
    gradients: np.ndarray
    targets: np.ndarray
    totals: np.ndarray


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        value = self[word] = crc32(word) % BUCKETS
        return value

    def of(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def fit_classifier(documents: DataFrame, labels: DataFrame, domain: str = "lang", labelled_limit: int = LABELLED_LIMIT) -> Classifier:
    """Word counts per domain over the labelled documents."""
    sample = labelled_sample(labels, [], labelled_limit)
    picked = F.broadcast(sample.select(F.col("doc_id").alias("picked_id")))
    rows = documents.select("doc_id", "text", F.col(domain).cast("string").alias("domain")).where("domain IS NOT NULL")
    rows = rows.join(picked, F.col("doc_id") == F.col("picked_id"), "left_semi").select("domain", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = _Buckets(), {}
        for batch in slices(batches, "text"):
            for name, text in zip(batch.column("domain").to_pylist(), texts(batch.column("text")), strict=True):
                table = counts.setdefault(name, np.zeros(BUCKETS, np.int64))
                table += np.bincount(words.of(text), minlength=BUCKETS)
        for name, table in counts.items():
            used = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(used), pa.string()), pa.array(used), pa.array(table[used])], ["domain", "bucket", "n"])

    counted = rows.mapInArrow(count, "domain string, bucket long, n long").groupBy("domain", "bucket").agg(F.sum("n").alias("n"))
    found = few_cells(counted, ["domain"], "bucket", "n", MAX_DOMAINS * BUCKETS)
    domains = sorted({r.domain for r in found}) or [""]
    counts = np.ones((BUCKETS, len(domains)))
    place = {name: i for i, name in enumerate(domains)}
    for r in found:
        counts[r.bucket, place[r.domain]] += r.n
    totals = counts.sum(0)
    return Classifier(domains, np.log(counts / totals), totals / totals.sum())


def membership(buckets: np.ndarray, model: Classifier) -> np.ndarray:
    """Mean posterior over windows of words, weighted by their length."""
    if not len(buckets):
        return model.prior
    starts = np.arange(0, len(buckets), WINDOW)
    scores = np.add.reduceat(model.logs[buckets], starts, axis=0) + np.log(model.prior)
    scores = np.exp(scores - scores.max(1, keepdims=True))
    lengths = np.diff(np.append(starts, len(buckets)))
    return (scores / scores.sum(1, keepdims=True) * lengths[:, None]).sum(0) / len(buckets)


def _members(batch: pa.RecordBatch, words: _Buckets, model: Classifier) -> tuple[np.ndarray, np.ndarray]:
    found = [words.of(t) for t in texts(batch.column("text"))]
    return np.array([len(b) for b in found], np.int64), np.array([membership(b, model) for b in found]).reshape(len(found), len(model.domains))


def memberships(documents: DataFrame, model: Classifier) -> DataFrame:
    """(doc_id, n_tokens, membership) of every row."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Buckets()
        for batch in slices(batches, "text"):
            sizes, shares = _members(batch, words, model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes), pa.array(list(shares), pa.list_(pa.float64()))], ["doc_id", "n_tokens", "membership"])

    return documents.select("doc_id", "text").mapInArrow(find, "doc_id long, n_tokens long, membership array<double>")


def replay(shares: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray]:
    """Rate of each membership after the plan's steps, and the point at which the next gradient is taken."""
    rate = np.ones(len(shares))
    ahead, t = rate, 1.0
    for gradient in plan.gradients:
        fresh = np.maximum(plan.floor, ahead - plan.step * (shares @ gradient + PULL * (ahead - 1)))
        t, before = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        ahead, rate = fresh + (before - 1) / t * (fresh - rate), fresh
    return rate, ahead


def _sums(members: DataFrame, width: int, value) -> np.ndarray:
    """Sum of ``value(sizes, shares)``, a vector, over all rows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                sizes = batch.column("n_tokens").to_numpy(zero_copy_only=False).astype(float)
                total += value(sizes, np.array(batch.column("membership").flatten()).reshape(len(sizes), -1))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(total)], ["place", "total"])

    parts = members.select("n_tokens", "membership").mapInArrow(add, "place long, total double")
    out = np.zeros(width)
    for row in few_rows(parts.groupBy("place").agg(F.sum("total").alias("total")), width):
        out[row.place] = row.total
    return out


def default_targets(totals: np.ndarray) -> np.ndarray:
    """Flattened shares of the found totals, scaled so that no domain has to shrink."""
    known = np.where(totals > 0, totals, 1.0)
    wanted = np.where(totals > 0, known**FLATTEN, 0.0)
    return wanted * (totals / np.where(wanted > 0, wanted, 1.0)).max() if totals.any() else totals


def fit_rates(members: DataFrame, n_domains: int, targets: np.ndarray | None = None, floor: float = 0.0) -> Plan:
    """Projected gradient over staged memberships; ``targets`` are tokens by domain."""
    d = n_domains
    first = _sums(members, d + d * d, lambda n, p: np.concatenate([n @ p, ((p * n[:, None]).T @ p).ravel()]))
    totals, square = first[:d], first[d:].reshape(d, d)
    wanted = default_targets(totals) if targets is None else np.asarray(targets, float)
    tokens = totals.sum()
    scale = np.where(wanted > 0, wanted, max(tokens, 1.0) / d)
    live = totals > 0
    curve = tokens * square / np.outer(scale, scale)
    step = 1 / (float(np.linalg.eigvalsh(curve)[-1]) + PULL) if tokens else 1.0
    plan = Plan(step, floor, np.zeros((0, d)), wanted, totals)
    reached = totals
    for _ in range(STEPS):
        miss = np.where(live, (reached - wanted) / scale, 0.0)
        if np.abs(miss).max(initial=0.0) < TOLERANCE:
            break
        plan.gradients = np.vstack([plan.gradients, tokens * miss / scale])
        reached = _sums(members, d, lambda n, p, plan=plan: (n * replay(p, plan)[1]) @ p)
    return plan


def _copies(ids: list, rate: np.ndarray) -> np.ndarray:
    """Whole copies: the rate rounded by a fixed draw from the doc_id."""
    draw = np.array([crc32(b"copies:" + str(i).encode()) for i in ids], float) / 2**32
    return np.floor(rate + draw).astype(np.int64)


def rates(members: DataFrame, plan: Plan) -> DataFrame:
    """doc_id, n_tokens, membership, rate and copies of every row."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rate, _ = replay(np.array(batch.column("membership").flatten()).reshape(batch.num_rows, -1), plan)
                copies = _copies(batch.column("doc_id").to_pylist(), rate)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate), pa.array(copies)], [*batch.schema.names, "rate", "copies"])

    return members.select("doc_id", "n_tokens", "membership").mapInArrow(find, RATES)


def mix(documents: DataFrame, labels: DataFrame, domain: str = "lang", targets: dict[str, float] | None = None, floor: float = 0.0) -> tuple[DataFrame, Classifier, Plan]:
    """Memberships (staged), classifier and plan for a corpus; ``targets`` gives tokens by domain name."""
    model = fit_classifier(documents, labels, domain)
    members = stage_table(memberships(documents, model), "members")
    wanted = None if targets is None else np.array([targets.get(name, 0.0) for name in model.domains])
    return members, model, fit_rates(members, len(model.domains), wanted, floor)


def remix(documents: DataFrame, model: Classifier, plan: Plan) -> DataFrame:
    """Every document as often as its rate says, with all its columns."""

    def repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Buckets()
        for batch in slices(batches, "text"):
            _, shares = _members(batch, words, model)
            copies = _copies(batch.column("doc_id").to_pylist(), replay(shares, plan)[0])
            yield batch.take(pa.array(np.repeat(np.arange(batch.num_rows), copies)))

    return documents.mapInArrow(repeat, documents.schema)
