"""Exact evaluation of scores in [0, 1] with at most six decimals.

Rows are first reduced to counts per distinct score, of which there are at most a million and one per group; the
ordered sums run in slots of a thousandth. ``by`` columns name few groups (versions, splits, features, periods).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duebook.functions.keys import digest_number, key_digest
from duebook.operators.ordering import exact_quantiles, running_totals

SLOT_WIDTH = 1000
# Threshold sweep in hundredths and the separation above which leakage is suspected.
SWEEP_FROM, SWEEP_TO = 30, 69
SUSPECT_KS = 0.70


def score_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score."""
    slot = F.floor(F.col("score") * SLOT_WIDTH).cast("int").alias("slot")
    return scored.groupBy(*by, slot, "score").agg(
        F.sum(F.col("label").cast("bigint")).alias("pos"), F.sum(F.lit(1) - F.col("label")).cast("bigint").alias("neg")
    )


def _with_totals(rows: DataFrame, counts: DataFrame, by: Sequence[str]) -> DataFrame:
    if not by:
        return rows.withColumns({f"all_{c}": counts.agg(F.sum(c)).scalar() for c in ("pos", "neg")})
    totals = counts.groupBy(*by).agg(*[F.sum(c).alias(f"all_{c}") for c in ("pos", "neg")])
    return rows.join(totals, list(by))


def ordered_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score: its counts, counts up to it and in all."""
    counts = score_counts(scored, by)
    running = running_totals(
        counts.withColumn("upto_pos", F.col("pos")).withColumn("upto_neg", F.col("neg")),
        by,
        ["slot"],
        ["score"],
        {"upto_pos": "upto_pos", "upto_neg": "upto_neg"},
    )
    return _with_totals(running, counts, by)


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def f1_of(tp: Column, fp: Column, fn: Column) -> Column:
    return safe_ratio(2 * tp, 2 * tp + fp + fn)


def classification_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, binary and weighted F1 in one aggregate; empty denominators give 0."""
    y, p = F.col("label"), F.col("predicted")

    def cell(truth: int, guess: int) -> Column:
        return F.count(F.when((y == truth) & (p == guess), 1))

    cells = scored.groupBy(*by).agg(
        cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn")
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    total = tp + fp + fn + tn
    weighted = safe_ratio((tp + fn) * f1_of(tp, fp, fn) + (tn + fp) * f1_of(tn, fn, fp), total)
    return cells.select(
        *by,
        total.alias("n"),
        F.round(safe_ratio(tp + tn, total), 6).alias("accuracy"),
        F.round(safe_ratio(tp, tp + fp), 6).alias("precision"),
        F.round(safe_ratio(tp, tp + fn), 6).alias("recall"),
        F.round(f1_of(tp, fp, fn), 6).alias("f1"),
        F.round(weighted, 6).alias("f1_weighted"),
    )


def confusion_matrix(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*by, "label", "predicted").agg(F.count(F.lit(1)).alias("n"))


def auc(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve as the tie-averaged rank statistic; 0 when a class is missing."""
    o = ordered_counts(scored, by)
    below = F.col("upto_neg") - F.col("neg")
    area = F.sum(F.col("pos") * (below + F.col("neg") / 2.0))
    pairs = F.max("all_pos").cast("double") * F.max("all_neg").cast("double")
    return o.groupBy(*by).agg(F.round(safe_ratio(area, pairs), 6).alias("auc"))


def roc_points(scored: DataFrame) -> DataFrame:
    """One point per distinct score: rates of rows scored at least that high."""
    o = ordered_counts(scored)
    above = {c: F.col(f"all_{c}") - F.col(f"upto_{c}") + F.col(c) for c in ("pos", "neg")}
    return o.select(
        F.col("score").alias("threshold"),
        F.round(safe_ratio(above["neg"], F.col("all_neg")), 6).alias("false_positive_rate"),
        F.round(safe_ratio(above["pos"], F.col("all_pos")), 6).alias("true_positive_rate"),
    )


def precision_recall_points(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    o = ordered_counts(scored, by)
    tp = F.col("all_pos") - F.col("upto_pos") + F.col("pos")
    fp = F.col("all_neg") - F.col("upto_neg") + F.col("neg")
    return o.select(
        *by,
        F.col("score").alias("threshold"),
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, F.col("all_pos")).alias("recall"),
        safe_ratio(F.col("pos"), F.col("all_pos")).alias("recall_step"),
    )


def average_precision(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    points = precision_recall_points(scored, by)
    return points.groupBy(*by).agg(
        F.round(F.sum(F.col("recall_step") * F.col("precision")), 6).alias("average_precision"),
        F.count(F.lit(1)).alias("n_points"),
    )


def ks(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Largest gap between the score distributions of the two classes."""
    o = ordered_counts(scored, by)
    gap = F.abs(
        safe_ratio(F.col("upto_pos"), F.col("all_pos")) - safe_ratio(F.col("upto_neg"), F.col("all_neg"))
    )
    return o.groupBy(*by).agg(F.round(F.max(gap), 6).alias("ks"))


def score_report(scored: DataFrame, by: Sequence[str], bands: Sequence[float] = (), cut: float = 0.5) -> DataFrame:
    """Every figure of a score from one table of counts: confusion cells at ``cut``, AUC, KS, average precision, mean and
    median, rates, and ``band_0``… with the rows below the first edge, between the edges, and from the last one on."""
    o = ordered_counts(scored, by)
    pos, neg, score = F.col("pos"), F.col("neg"), F.col("score")
    all_pos, all_neg, rows = F.col("all_pos"), F.col("all_neg"), F.col("all_pos") + F.col("all_neg")
    above = {c: F.col(f"all_{c}") - F.col(f"upto_{c}") + F.col(c) for c in ("pos", "neg")}
    gap = F.abs(safe_ratio(F.col("upto_pos"), all_pos) - safe_ratio(F.col("upto_neg"), all_neg))
    step = safe_ratio(pos, all_pos) * safe_ratio(above["pos"], above["pos"] + above["neg"])
    upto = F.col("upto_pos") + F.col("upto_neg")
    zero = F.lit(0).cast("bigint")

    def total(count: Column, when: Column) -> Column:
        return F.sum(F.when(when, count).otherwise(zero))

    edges = [float("-inf"), *bands, float("inf")]
    found = o.groupBy(*by).agg(
        total(pos, score >= cut).alias("tp"),
        total(neg, score >= cut).alias("fp"),
        total(pos, score < cut).alias("fn"),
        total(neg, score < cut).alias("tn"),
        F.sum(pos * (F.col("upto_neg") - neg + neg / 2.0)).alias("area"),
        F.max(gap).alias("gap"),
        F.sum(step).alias("steps"),
        F.sum(score * (pos + neg)).alias("scores"),
        F.min(F.when(upto * 2 >= rows, score)).alias("low_middle"),
        F.min(F.when(upto * 2 > rows, score)).alias("high_middle"),
        *[
            total(pos + neg, (score >= low) & (score < high)).alias(f"band_{i}")
            for i, (low, high) in enumerate(zip(edges, edges[1:]))
        ],
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    weighted = safe_ratio((tp + fn) * f1_of(tp, fp, fn) + (tn + fp) * f1_of(tn, fn, fp), n)
    figures = {
        "accuracy": safe_ratio(tp + tn, n),
        "precision": safe_ratio(tp, tp + fp),
        "recall": safe_ratio(tp, tp + fn),
        "f1": f1_of(tp, fp, fn),
        "f1_weighted": weighted,
        "auc": safe_ratio(F.col("area"), (tp + fn).cast("double") * (tn + fp).cast("double")),
        "ks": F.col("gap"),
        "average_precision": F.col("steps"),
        "mean_score": safe_ratio(F.col("scores"), n),
        "median_score": (F.col("low_middle") + F.col("high_middle")) / 2,
        "positive_rate": safe_ratio(tp + fn, n),
        "predicted_rate": safe_ratio(tp + fp, n),
    }
    kept = [f"band_{i}" for i in range(len(edges) - 1)]
    return found.select(*by, n.alias("n"), *[F.round(c, 6).alias(name) for name, c in figures.items()], *kept)


def threshold_sweep(scored: DataFrame) -> DataFrame:
    """F1 at each threshold and whether it is the best (lowest threshold on ties).

    Rows are counted per hundredth of the score; the sums over higher hundredths run over those few rows.
    """
    millionths = F.round(F.col("score") * 1_000_000).cast("int")
    hundredth = F.least(F.floor(millionths / 10_000).cast("int"), F.lit(SWEEP_TO))
    y = F.col("label").cast("bigint")
    counted = scored.groupBy(F.greatest(hundredth, F.lit(SWEEP_FROM - 1)).alias("h")).agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")
    )
    zero = F.lit(0).cast("bigint")
    empty = scored.sparkSession.range(SWEEP_FROM, SWEEP_TO + 1).select(
        F.col("id").cast("int").alias("h"), zero.alias("pos"), zero.alias("neg")
    )
    bins = counted.unionByName(empty).groupBy("h").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    downwards = Window.orderBy(F.desc("h")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tp, fp = F.sum("pos").over(downwards), F.sum("neg").over(downwards)
    sums = bins.select("h", tp.alias("tp"), fp.alias("fp"), F.sum("pos").over(Window.partitionBy()).alias("all_pos"))
    points = sums.filter(F.col("h") >= SWEEP_FROM).select(
        (F.col("h") / 100.0).alias("threshold"),
        F.round(f1_of(F.col("tp"), F.col("fp"), F.col("all_pos") - F.col("tp")), 6).alias("f1"),
    )
    place = F.row_number().over(Window.orderBy(F.desc("f1"), "threshold"))
    return points.select("threshold", "f1", (place == 1).cast("int").alias("is_best"))


def decile_edges(scored: DataFrame) -> list[float]:
    """The distinct interior decile edges of the score (at most nine numbers)."""
    levels = {f"q{i}": i / 10 for i in range(1, 10)}
    row = exact_quantiles(scored.select("score"), ["score"], levels).first()
    return sorted({row[q] for q in levels})


def decile_table(scored: DataFrame) -> DataFrame:
    """Size and positive rate per score decile, 1 = highest scores; equal scores stay together."""
    edges = decile_edges(scored)
    low = F.lit(0)
    for edge in edges:
        low = low + (F.col("score") > edge).cast("int")
    grouped = scored.groupBy(low.alias("low")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("label").cast("bigint")).alias("positives")
    )
    # at most ten rows from here on
    numbered = grouped.withColumn("decile", F.row_number().over(Window.orderBy(F.desc("low"))))
    return numbered.select(
        "decile", "n", "positives", F.round(F.col("positives") * 100.0 / F.col("n"), 4).alias("positive_pct")
    )


def decile_inversions(table: DataFrame) -> DataFrame:
    """How often the rate rises from one decile to the next lower-risk one."""
    before = F.lag("positive_pct").over(Window.orderBy("decile"))
    steps = table.select((before < F.col("positive_pct")).cast("int").alias("rises"))
    return steps.agg(
        F.count(F.lit(1)).alias("n_deciles"), F.coalesce(F.sum("rises"), F.lit(0)).cast("bigint").alias("inversions")
    )


def by_digest(df: DataFrame, key: str, position: str, within: Sequence[str] = (), salt: str = "") -> DataFrame:
    """Numbers the rows (within few groups) in the order of the key's digest; digests fill the slots evenly."""
    kept = df.columns
    digest = key_digest(F.col(key), salt)
    rows = df.withColumn("__digest", digest).withColumn("__slot", digest_number(F.col("__digest"), 3))
    rows = rows.withColumn(position, F.lit(1).cast("bigint"))
    numbered = running_totals(rows, within, ["__slot"], ["__digest", key], {position: position})
    return numbered.select(*kept, position)


def stratified_split(scored: DataFrame, key: str = "customer_id", train_tenths: int = 8) -> DataFrame:
    """Adds ``split`` (train or test), with the same share of each label on both sides."""
    numbered = by_digest(scored, key, "position", ["label"])
    sizes = scored.groupBy("label").agg(F.count(F.lit(1)).alias("label_rows"))
    # one row per label
    sized = numbered.join(F.broadcast(sizes), "label")
    train = F.col("position") * 10 <= F.col("label_rows") * train_tenths
    return sized.withColumn("split", F.when(train, "train").otherwise("test")).select(*scored.columns, "split")


def class_balance(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Class counts and the negative-to-positive ratio, the weight of the positive class."""
    pos, neg = F.count(F.when(F.col("label") == 1, 1)), F.count(F.when(F.col("label") == 0, 1))
    return df.groupBy(*by).agg(
        pos.alias("n_pos"), neg.alias("n_neg"), F.round(F.try_divide(neg.cast("double"), pos), 6).alias("pos_weight")
    )


def ks_train_test(split: DataFrame) -> DataFrame:
    per_split = ks(split, ["split"])
    return per_split.agg(
        F.max(F.when(F.col("split") == "train", F.col("ks"))).alias("ks_train"),
        F.max(F.when(F.col("split") == "test", F.col("ks"))).alias("ks_test"),
    ).select(
        "ks_train",
        "ks_test",
        F.round(F.col("ks_train") - F.col("ks_test"), 6).alias("ks_gap"),
        (F.col("ks_test") > SUSPECT_KS).cast("int").alias("suspect_leakage"),
    )


def permutation_importance(df: DataFrame, features: Sequence[str], score, key: str = "customer_id") -> DataFrame:
    """AUC lost when one feature's values are dealt to other rows, for all features in one job.

    Values move from the row at a place in one digest order to the row at that place in another: every row gives and
    receives exactly once. ``score`` is a function of the feature columns.
    """
    receivers = by_digest(df, key, "place", salt="r")
    donors = by_digest(df.select(key, *features), key, "place", salt="d")
    dealt = receivers.join(donors.select("place", *[F.col(f).alias(f"other_{f}") for f in features]), "place")
    options = [F.struct(F.lit("none").alias("feature"), score(*[F.col(f) for f in features]).alias("score"))]
    for name in features:
        inputs = [F.col(f"other_{f}" if f == name else f) for f in features]
        options.append(F.struct(F.lit(name).alias("feature"), score(*inputs).alias("score")))
    areas = auc(dealt.select("label", F.inline(F.array(*options))), ["feature"])
    # one row per feature
    whole = Window.partitionBy()
    base = F.max(F.when(F.col("feature") == "none", F.col("auc"))).over(whole)
    return (
        areas.withColumn("base_auc", base)
        .filter(F.col("feature") != "none")
        .select("feature", "base_auc", "auc", F.round(F.col("base_auc") - F.col("auc"), 6).alias("auc_drop"))
    )


def score_summary(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean, median and deviation of the score. Rows become counts and partial moments per distinct score first, at most
    a million and one per group, so that no task holds more values than that for the median."""
    counts = scored.groupBy(*by, "score").agg(F.count(F.lit(1)).alias("n"))
    many, score = F.col("n"), F.col("score")
    # the scores lie in [0, 1]: their sums lose no digit that shows in six
    sums = [F.sum(many).alias("n"), F.sum(F.when(score.isNotNull(), many)).alias("known")]
    sums += [F.sum(score * many).alias("total"), F.sum(score * score * many).alias("squares")]
    found = counts.groupBy(*by).agg(*sums, F.percentile("score", F.lit(0.5), many).alias("median"))
    mean = F.try_divide(F.col("total"), F.col("known"))
    spread = F.greatest(F.col("squares") - F.col("total") * mean, F.lit(0.0))
    return found.select(
        *by,
        "n",
        F.round(mean, 6).alias("mean_score"),
        F.round("median", 6).alias("median_score"),
        F.round(F.sqrt(F.try_divide(spread, F.col("known") - 1)), 6).alias("sd_score"),
    )


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    y, e = F.col(actual), F.col(actual) - F.col(predicted)
    spread = F.var_pop(y) * F.count(y)
    return df.agg(
        F.count(y).alias("n"),
        F.round(F.avg(F.abs(e)), 4).alias("mae"),
        F.round(F.sqrt(F.avg(e * e)), 4).alias("rmse"),
        F.round(F.lit(1.0) - F.try_divide(F.sum(e * e), spread), 6).alias("r2"),
    )
