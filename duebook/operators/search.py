"""Random search over boosted trees with stratified folds and a class weight for every fold.

One aggregate turns the rows into cells: counts of both labels per fold and bin of every input. Bins are quantiles, and
their number falls with the number of inputs, so the cells have a fixed bound whatever the number of rows. Histogram trees
see the same sums on cells as on rows. Each pair of a setting and a held-out fold is fitted from the cells in a task of
its own. The table of results is written once and read from there.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.operators.evaluate import by_digest
from duebook.operators.ordering import exact_quantiles
from duebook.operators.scorecard import assert_no_leakage
from duebook.session import workspace

SEED = 42
TRIALS, FOLDS = 30, 5
# The tuning space.
DEPTHS, STEPS, ROUNDS, CHILD_WEIGHTS, SHARES = (3, 10), (0.01, 0.3), (50, 300), (1, 10), (0.6, 1.0)
#: Most cells, and most values of one category.
MOST_CELLS, MOST_CATEGORIES, MOST_BINS = 1 << 20, 32, 64
#: Added to the curvature of a leaf.
DAMPING = 1.0


class Setting(NamedTuple):
    depth: int
    step: float
    rounds: int
    child_weight: int
    row_share: float
    column_share: float


def settings(trials: int = TRIALS, seed: int = SEED) -> list[Setting]:
    """Random settings, the same for the same seed; step sizes are even in their logarithm."""
    pick = random.Random(seed)
    return [
        Setting(
            pick.randint(*DEPTHS),
            round(math.exp(pick.uniform(*map(math.log, STEPS))), 6),
            pick.randint(*ROUNDS),
            pick.randint(*CHILD_WEIGHTS),
            round(pick.uniform(*SHARES), 6),
            round(pick.uniform(*SHARES), 6),
        )
        for _ in range(trials)
    ]


def add_stratified_folds(rows: DataFrame, key: str, folds: int = FOLDS) -> DataFrame:
    """Adds ``fold``: within each label the rows are dealt in the order of their key's digest, so folds differ by at most
    one row a label."""
    placed = by_digest(rows, key, "__place", ["label"], salt="fold")
    return placed.withColumn("fold", F.pmod(F.col("__place") - 1, F.lit(folds)).cast("int")).drop("__place")


def fold_weights(rows: DataFrame) -> DataFrame:
    """Per fold its label counts, and the weight that positives get when it is held out: negatives over positives of the
    other folds."""
    counts = rows.groupBy("fold").agg(F.count_if(F.col("label") == 1).alias("n_pos"), F.count_if(F.col("label") == 0).alias("n_neg"))
    all_pos, all_neg = (counts.agg(F.sum(c)).scalar() for c in ("n_pos", "n_neg"))
    left_pos, left_neg = all_pos - F.col("n_pos"), all_neg - F.col("n_neg")
    weight = F.coalesce(F.try_divide(left_neg.cast("double"), left_pos), F.lit(1.0))
    return counts.select("fold", "n_pos", "n_neg", left_pos.alias("train_pos"), left_neg.alias("train_neg"), F.round(weight, 6).alias("pos_weight"))


def bins_for(numeric: int, categories: int, folds: int) -> int:
    """The most bins a numeric input may have so that all cells stay below the bound."""
    free = MOST_CELLS / folds / MOST_CATEGORIES**categories
    return max(2, min(MOST_BINS, math.floor(free ** (1 / numeric))))


def cells(rows: DataFrame, numeric: Sequence[str], categories: Sequence[str], folds: int = FOLDS) -> DataFrame:
    """(fold, b0…, categories, pos, neg): label counts per bin of each input. A null is in a bin of its own."""
    assert_no_leakage([*numeric, *categories])
    n_bins = bins_for(len(numeric), len(categories), folds)
    levels = {f"q{i}": i / n_bins for i in range(1, n_bins)}
    found = exact_quantiles(rows, numeric, levels).take(len(numeric))
    edges = {r["feature"]: sorted({float(r[q]) for q in levels}) for r in found}

    def bin_of(name: str) -> Column:
        value = F.col(name).cast("double")
        above = F.size(F.filter(F.array(*map(F.lit, edges.get(name) or [0.0])), lambda edge: edge < value)) + 1
        return F.when(value.isNull(), 0).otherwise(above)

    bins = [bin_of(name).cast("int").alias(f"b{i}") for i, name in enumerate(numeric)]
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in categories]
    return rows.groupBy("fold", *bins, *names).agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))


def _best_split(codes: np.ndarray, node: np.ndarray, grad: np.ndarray, curve: np.ndarray, inputs: np.ndarray, child: float):
    """Per node the gain, input and code of its best split."""
    nodes, width = int(node.max()) + 1, int(codes.max()) + 1
    all_grad, all_curve = np.bincount(node, grad, nodes), np.bincount(node, curve, nodes)
    rest = all_grad**2 / (all_curve + DAMPING)
    gain, best, cut = np.zeros(nodes), np.zeros(nodes, int), np.zeros(nodes, int)
    for i in inputs:
        place = node * width + codes[:, i]
        left_grad, left_curve = (np.bincount(place, v, nodes * width).reshape(nodes, width).cumsum(1)[:, :-1] for v in (grad, curve))
        right_grad, right_curve = all_grad[:, None] - left_grad, all_curve[:, None] - left_curve
        found = left_grad**2 / (left_curve + DAMPING) + right_grad**2 / (right_curve + DAMPING) - rest[:, None]
        found[(left_curve < child) | (right_curve < child)] = 0
        at = found.argmax(1)
        better = found[np.arange(nodes), at] > gain + 1e-9
        gain, best, cut = np.where(better, found[np.arange(nodes), at], gain), np.where(better, i, best), np.where(better, at, cut)
    return gain, best, cut


def margins(codes: np.ndarray, pos: np.ndarray, neg: np.ndarray, weight: float, setting: Setting, seed: int) -> np.ndarray:
    """Log-odds of every cell after boosting on the counts; cells without counts are scored, not learnt from."""
    chance = np.random.default_rng(seed)
    score = np.zeros(len(codes))
    inputs = codes.shape[1]
    for _ in range(setting.rounds):
        p = 1 / (1 + np.exp(-score))
        some_pos, some_neg = (chance.binomial(c, setting.row_share) for c in (pos, neg))
        grad = weight * some_pos * (p - 1) + some_neg * p
        curve = (weight * some_pos + some_neg) * p * (1 - p)
        chosen = chance.choice(inputs, max(1, round(setting.column_share * inputs)), replace=False)
        node = np.zeros(len(codes), int)
        for _ in range(setting.depth):
            gain, best, cut = _best_split(codes, node, grad, curve, chosen, setting.child_weight)
            right = (gain[node] > 0) & (codes[np.arange(len(codes)), best[node]] > cut[node])
            if not right.any():
                break
            node = np.unique(node * 2 + right, return_inverse=True)[1]
        score += setting.step * (-np.bincount(node, grad) / (np.bincount(node, curve) + DAMPING))[node]
    return score


def area(score: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> float:
    """Area under the ROC curve of counted cells, ties averaged; 0 when a class is missing."""
    place = np.unique(score, return_inverse=True)[1]
    p, n = np.bincount(place, pos), np.bincount(place, neg)
    pairs = p.sum() * n.sum()
    return float((p * (n.cumsum() - n / 2)).sum() / pairs) if pairs else 0.0


RESULT = "trial int, fold int, auc double, pos_weight double, n_train long, n_held long"


def _fit(trial: int, held: int, frame: pd.DataFrame, numeric: int, categories: Sequence[str], setting: Setting) -> pd.DataFrame:
    frame = frame.sort_values([c for c in frame.columns if c not in ("trial", "held")])
    hot = [frame[c].to_numpy() == value for c in categories for value in sorted(frame[c].unique())]
    codes = np.column_stack([*(frame[f"b{i}"].to_numpy(int) for i in range(numeric)), *hot]).astype(int)
    pos, neg = frame["pos"].to_numpy(), frame["neg"].to_numpy()
    train = frame["fold"].to_numpy() != held
    seen_pos, seen_neg = np.where(train, pos, 0), np.where(train, neg, 0)
    weight = seen_neg.sum() / seen_pos.sum() if seen_pos.sum() else 1.0
    score = margins(codes, seen_pos, seen_neg, weight, setting, SEED + trial)
    auc = area(score[~train], pos[~train], neg[~train])
    sizes = int(seen_pos.sum() + seen_neg.sum()), int((pos + neg)[~train].sum())
    return pd.DataFrame([(trial, held, auc, round(weight, 6), *sizes)], columns=[f.split()[0] for f in RESULT.split(", ")])


def fold_scores(counted: DataFrame, numeric: int, categories: Sequence[str], tried: Sequence[Setting], folds: int = FOLDS) -> DataFrame:
    """One row per setting and held-out fold. Each task gets the cells, which are bounded."""
    tried = list(tried)
    trial = F.explode(F.sequence(F.lit(1), F.lit(len(tried)))).alias("trial")
    pairs = counted.select("*", trial).select("*", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("held"))

    def fit(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return _fit(int(key[0]), int(key[1]), frame, numeric, categories, tried[int(key[0]) - 1])

    return pairs.groupBy("trial", "held").applyInPandas(fit, RESULT)


def search(rows: DataFrame, numeric: Sequence[str], categories: Sequence[str], key: str, trials: int = TRIALS, folds: int = FOLDS) -> DataFrame:
    """Settings with the mean area over the folds, best first, with the folds' extremes; fitted once and kept."""
    tried = settings(trials)
    counted = cells(add_stratified_folds(rows, key, folds), numeric, categories, folds)
    path = workspace(rows.sparkSession, "search")
    counted.write.parquet(f"{path}/cells")
    counted = rows.sparkSession.read.parquet(f"{path}/cells")
    fold_scores(counted, len(numeric), categories, tried, folds).write.parquet(f"{path}/scores")
    scores = rows.sparkSession.read.schema(RESULT).parquet(f"{path}/scores")
    known = rows.sparkSession.createDataFrame([(i, *s) for i, s in enumerate(tried, 1)], "trial int, depth int, step double, rounds int, child_weight int, row_share double, column_share double")
    means = scores.groupBy("trial").agg(
        F.count(F.lit(1)).cast("int").alias("n_folds"),
        F.round(F.avg("auc"), 6).alias("mean_auc"),
        F.round(F.min("auc"), 6).alias("worst_auc"),
        F.round(F.max("auc"), 6).alias("best_auc"),
        F.sum("n_held").alias("n_rows"),
    )
    return known.join(means, "trial").orderBy(F.desc("mean_auc"), "trial")
