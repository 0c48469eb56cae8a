"""Trend with change points: a level, a slope that may change at up to two weeks, and the effect of special weeks.

Candidates for a change lie evenly in the first part of a series. One aggregate gives, for every segment and set of
candidates, the sums of the normal equations; they are solved by elimination in column expressions, and the set with the
least penalised error (Bayesian information criterion) wins. A series is as long as the calendar, so a segment has some
hundreds of points times the sets.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duebook.operators import cashflow

CANDIDATES = 10
#: Changes lie in this part of a series, in tenths.
SEARCHED_TENTHS = 8
TERMS = ("u", "e", "h1", "h2")
#: A term explains nothing of its own below this share of its spread.
TOLERANCE = 1e-9


def normal_sums(terms: Sequence[str] = TERMS) -> dict[str, str]:
    """Names and products of the sums that the normal equations need; ``y`` is the target."""
    single = {f"s_{a}": a for a in (*terms, "y")}
    return single | {f"s_{a}_{b}": f"{a} * {b}" for a, b in combinations_with_replacement((*terms, "y"), 2)}


def elimination(terms: Sequence[str] = TERMS) -> list[dict[str, str]]:
    """Layers of expressions from the sums to coefficients ``b_…``, ``level`` and squared error ``sse``.

    Each layer reads columns of earlier ones only. A term that the ones before it explain gets the coefficient 0.
    """
    names = [*terms, "y"]
    layers = [{f"c0_{a}_{b}": f"s_{a}_{b} - s_{a} * s_{b} / n" for a, b in combinations_with_replacement(names, 2)}]
    for step, k in enumerate(terms):
        rest = names[step + 1 :]
        own = f"c{step}_{k}_{k}"
        known = f"{own} > {TOLERANCE!r} * c0_{k}_{k}"
        layers.append({f"f_{k}_{j}": f"CASE WHEN {known} THEN c{step}_{k}_{j} / {own} ELSE 0.0E0 END" for j in rest})
        pairs = combinations_with_replacement(rest, 2)
        layers.append({f"c{step + 1}_{a}_{b}": f"c{step}_{a}_{b} - f_{k}_{a} * c{step}_{k}_{b}" for a, b in pairs})
    for step in reversed(range(len(terms))):
        k, rest = terms[step], terms[step + 1 :]
        layers.append({f"b_{k}": " - ".join([f"f_{k}_y", *[f"f_{k}_{j} * b_{j}" for j in rest]])})
    level = " - ".join(["s_y", *[f"b_{k} * s_{k}" for k in terms]])
    layers.append({"level": f"({level}) / n", "sse": f"greatest(c{len(terms)}_y_y, 0.0E0)"})
    return layers


def criterion(n: str = "n", sse: str = "sse", knots: str = "knots") -> str:
    """Penalised error; a change costs its place and its slope."""
    return f"round({n} * ln(greatest({sse} / {n}, 1e-9)) + (3 + 2 * {knots}) * ln({n}), 6)"


def candidate_sets(count: int = CANDIDATES) -> list[tuple[int, int]]:
    """Numbers of the candidates in a set, 0 for none."""
    single = [(i, 0) for i in range(count + 1)]
    return single + [(i, j) for i in range(1, count + 1) for j in range(i + 1, count + 1)]


def place(number: str, span: str = "span", count: int = CANDIDATES) -> str:
    """Weeks from the first point to a candidate."""
    return f"floor({span} * {SEARCHED_TENTHS} * {number} / {10.0 * (count + 1)!r}E0)"


def fit_changes(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per segment the best fit: ``level``, slope ``b_u``, effect ``b_e``, changes ``b_h1``, ``b_h2`` at ``k1``, ``k2``."""
    points = points.select(*by, "week", "t", "special", "y")
    ends = points.groupBy(*by).agg(F.min("t").alias("first_t"), F.max("t").alias("last_t"), F.max("week").alias("last_week"))
    sets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in candidate_sets()])
    spread = points.join(ends, list(by)).select("*", (F.col("last_t") - F.col("first_t")).alias("span"), F.inline(sets))
    spread = spread.withColumns({"k1": F.expr(place("i")).cast("int"), "k2": F.expr(place("j")).cast("int")})
    u = (F.col("t") - F.col("first_t")).cast("double")
    hinges = {f"h{n}": F.when(F.col(c) > 0, F.greatest(u - F.col(f"k{n}"), F.lit(0.0))).otherwise(0.0) for n, c in ((1, "i"), (2, "j"))}
    terms = spread.withColumns({"u": u, "e": F.col("special").cast("double"), "y": F.col("y").cast("double"), **hinges})
    sums = [F.sum(F.expr(product)).alias(name) for name, product in normal_sums().items()]
    solved = terms.groupBy(*by, "i", "j", "k1", "k2", "first_t", "last_week").agg(F.count(F.lit(1)).cast("double").alias("n"), *sums)
    for layer in elimination():
        solved = solved.selectExpr("*", *[f"{expr} AS {name}" for name, expr in layer.items()])
    solved = solved.withColumn("knots", (F.col("i") > 0).cast("int") + (F.col("j") > 0).cast("int"))
    enough = (F.col("knots") == 0) | (F.col("n") > 4 + 2 * F.col("knots"))
    fields = ["first_t", "last_week", "n", "k1", "k2", "level", "b_u", "b_e", "b_h1", "b_h2", "sse"]
    order = F.struct(F.expr(criterion()).alias("criterion"), "knots", "i", "j", *fields)
    best = solved.where(enough).groupBy(*by).agg(F.min(order).alias("best"))
    return best.select(*by, "best.knots", *[f"best.{c}" for c in fields])


def predicted(t: Column, special: Column) -> Column:
    u = (t - F.col("first_t")).cast("double")
    bends = [F.col(f"b_h{n}") * F.greatest(u - F.col(f"k{n}"), F.lit(0.0)) for n in (1, 2)]
    return F.col("level") + F.col("b_u") * u + F.col("b_e") * special + bends[0] + bends[1]


def forecast(points: DataFrame, by: Sequence[str], weeks: int = cashflow.HORIZON_WEEKS) -> DataFrame:
    """The next ``weeks`` Mondays per segment, as ``cashflow.forecast`` gives them, along the bent trend."""
    fit = fit_changes(points, by)
    spent = F.greatest(F.col("n") - 3 - 2 * F.col("knots"), F.lit(1.0))
    return cashflow.project(fit.withColumn("sd", F.sqrt(F.col("sse") / spent)), by, weeks, predicted)


def backtest(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean absolute error on the last part of each series, along the bent and along the straight trend."""
    parts = cashflow.holdout(points, by)
    train, held = parts.where(F.col("i") <= F.col("n_train")), parts.where(F.col("i") > F.col("n_train"))
    sizes = [F.max("n_train").alias("n_train"), F.count(F.lit(1)).alias("n_holdout")]

    def errors(fit: DataFrame, value, name: str) -> DataFrame:
        error = F.abs(F.col("y").cast("double") - value(F.col("t"), F.col("special")))
        return held.join(fit, list(by)).groupBy(*by).agg(*sizes, F.avg(error).alias(name))

    bent = errors(fit_changes(train, by), predicted, "bent")
    straight = errors(cashflow.fit_trend(train, by), cashflow.predicted, "straight").select(*by, "straight")
    enough = (F.col("n_train") >= cashflow.MIN_TRAIN) & (F.col("n_holdout") >= cashflow.MIN_HOLDOUT)
    shown = [F.when(enough, F.round(c, 2)).alias(f"mae_{c}") for c in ("bent", "straight")]
    return bent.join(straight, list(by)).select(*by, "n_train", "n_holdout", *shown)
