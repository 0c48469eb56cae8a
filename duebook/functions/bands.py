"""Banding expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_below(value: Column, steps: Sequence[tuple[float, object]], otherwise: object) -> Column:
    """Left-closed bands: the label of the first bound that ``value`` is below; NULL gets ``otherwise``."""
    result = F.lit(otherwise)
    for bound, label in reversed(list(steps)):
        result = F.when(value < bound, F.lit(label)).otherwise(result)
    return result


def first_reached(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Descending lower bounds: the label of the first bound that ``value`` reaches."""
    result = F.lit(otherwise)
    for bound, label in reversed(list(steps)):
        result = F.when(value >= bound, F.lit(label)).otherwise(result)
    return result


def right_closed(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Bins ``(edge[i], edge[i+1]]``; values outside every bin are NULL."""
    result = F.lit(None).cast("string")
    for low, high, label in reversed(list(zip(edges[:-1], edges[1:], labels))):
        inside = F.lit(True)
        if low != float("-inf"):
            inside = inside & (value > low)
        if high != float("inf"):
            inside = inside & (value <= high)
        result = F.when(value.isNotNull() & inside, F.lit(label)).otherwise(result)
    return result
