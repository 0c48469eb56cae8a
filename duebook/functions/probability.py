"""Distribution functions as column expressions (Spark SQL has no erf)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Abramowitz & Stegun 7.1.26, absolute error below 1.5e-7.
ERF_P = 0.3275911
ERF_COEFFICIENTS = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def erf_positive(x: Column) -> Column:
    """erf for x >= 0."""
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(ERF_P) * x)
    poly = F.lit(0.0)
    for c in reversed(ERF_COEFFICIENTS):
        poly = (poly + F.lit(c)) * t
    return F.lit(1.0) - poly * F.exp(-x * x)


def normal_cdf(z: Column) -> Column:
    half_width = erf_positive(F.abs(z) / F.lit(math.sqrt(2.0)))
    return F.lit(0.5) * (F.lit(1.0) + F.signum(z) * half_width)


def two_class_chi2_p(statistic: Column) -> Column:
    """Upper tail for one degree of freedom."""
    return F.lit(2.0) * (F.lit(1.0) - normal_cdf(F.sqrt(statistic)))


def chi2_p(statistic: Column, dof: Column) -> Column:
    """Upper tail for ``dof`` degrees of freedom.

    Starts from the closed form for one or two degrees and adds the terms of the step-by-two recurrence.
    """
    half = statistic / 2.0
    odd = dof % 2 == 1
    first_tail = F.when(odd, two_class_chi2_p(statistic)).otherwise(F.exp(-half))
    first_term = F.when(odd, F.sqrt(half) * F.exp(-half) / math.gamma(1.5)).otherwise(half * F.exp(-half))
    shift = F.when(odd, F.lit(0.5)).otherwise(F.lit(1.0))
    start = F.struct(first_tail.alias("tail"), first_term.alias("term"))
    steps = F.when(dof > 2, F.sequence(F.lit(1), F.floor((dof - 1) / 2).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )
    return F.aggregate(
        steps,
        start,
        lambda acc, i: F.struct(
            (acc["tail"] + acc["term"]).alias("tail"),
            (acc["term"] * half / (i.cast("double") + shift)).alias("term"),
        ),
        lambda acc: acc["tail"],
    )


def kolmogorov_p(distance: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample Kolmogorov-Smirnov p-value."""
    size = n.cast("double") * m.cast("double") / (n + m).cast("double")
    lam = distance * F.sqrt(size)
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc
        + F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        * F.exp(F.lit(-2.0) * k.cast("double") * k.cast("double") * lam * lam),
    )
    p = F.least(F.greatest(F.lit(2.0) * series, F.lit(0.0)), F.lit(1.0))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(p)
