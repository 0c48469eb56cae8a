"""Numeric profiles and correlations of wide feature tables, in one pass over all columns."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duebook.operators.ordering import nth_rows, number_or_null
from duebook.session import stage

LEAK_CORRELATION = 0.95
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def describe_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per feature."""
    staged = stage(df.select(*[number_or_null(F.col(f)).alias(f) for f in features]))
    moments = {"n": F.count, "mean": F.avg, "sd": F.stddev_samp, "min": F.min, "max": F.max}
    row = staged.agg(*[make(f).alias(f"{m}_{i}") for i, f in enumerate(features) for m, make in moments.items()]).first()
    sizes = {f: row[f"n_{i}"] for i, f in enumerate(features) if row[f"n_{i}"]}
    ranks = {f: {name: level * (n - 1) for name, level in QUARTILES.items()} for f, n in sizes.items()}
    positions = {f: sorted({at for r in ranks[f].values() for at in (math.floor(r) + 1, math.ceil(r) + 1)}) for f in sizes}
    values = nth_rows(staged, positions, max(sizes.values())) if sizes else {}
    table = []
    for i, f in enumerate(features):
        if f in sizes:
            own = [row[f"{m}_{i}"] for m in moments]
            for rank in ranks[f].values():
                low, high = (values[f][at][0] for at in (math.floor(rank) + 1, math.ceil(rank) + 1))
                own.append(low + (high - low) * (rank - math.floor(rank)))
            table.append((f, *own))
    # one row per feature
    found = df.sparkSession.createDataFrame(table, "feature string, n bigint, mean double, sd double, min double, max double, q1 double, median double, q3 double")
    rounded = [F.round("mean", 4).alias("mean"), F.round("sd", 4).alias("sd")]
    return found.select("feature", "n", *rounded, "min", "max", *[F.round(q, 6).alias(q) for q in QUARTILES])


def correlation_pairs(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of features, all in one aggregate."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1 :]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    rows = [
        F.struct(F.lit(a).alias("left_feature"), F.lit(b).alias("right_feature"),
                 F.round(F.nanvl(F.col(f"{a}|{b}"), F.lit(None)), 6).alias("correlation"))
        for a, b in pairs
    ]
    return wide.select(F.inline(F.array(*rows)))


def leakage_scan(df: DataFrame, features: Sequence[str], label: str, top: int = 10) -> DataFrame:
    """The features most correlated with the label, flagged where the correlation is suspicious."""
    wide = df.agg(*[F.corr(F.col(f).cast("double"), F.col(label).cast("double")).alias(f) for f in features])
    rows = [F.struct(F.lit(f).alias("feature"), F.round(F.col(f), 6).alias("correlation")) for f in features]
    long = wide.select(F.inline(F.array(*rows)))
    ranked = long.orderBy(F.desc_nulls_last(F.abs("correlation")), "feature").limit(top)
    return ranked.withColumn("suspicious", (F.abs("correlation") > LEAK_CORRELATION).cast("int"))


def zscores(df: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """Features with mean 0 and deviation 1 (NULL counts as 0); a constant feature becomes 0."""
    filled = df.select(key, *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f) for f in features])
    moments = filled.agg(
        F.struct(*[F.avg(f).alias(f) for f in features]).alias("mean"),
        F.struct(*[F.stddev(f).alias(f) for f in features]).alias("sd"),
    )
    scaled = filled.withColumns({f"__{c}": moments.select(c).scalar() for c in ("mean", "sd")})
    return scaled.select(
        key,
        *[
            F.round(
                F.coalesce(F.try_divide(F.col(f) - F.col(f"__mean.{f}"), F.col(f"__sd.{f}")), F.lit(0.0)), 6
            ).alias(f)
            for f in features
        ],
    )


def one_hot(df: DataFrame, key: str, column: str) -> DataFrame:
    """One 0/1 column per category, named ``<column>_<category>``; the categories must be few."""
    names = sorted(r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().take(1001))
    if len(names) > 1000:
        raise ValueError(f"{column} has too many categories to spread over columns")
    return df.select(key, *[F.coalesce((F.col(column) == v).cast("int"), F.lit(0)).alias(f"{column}_{v}") for v in names])
