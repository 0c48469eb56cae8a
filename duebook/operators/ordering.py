"""Order-dependent results without a single task holding all rows.

A window without PARTITION BY sends every row to one task. Here rows are first assigned to *slots*: ranges of the
ordering value, numbered in order. Slot totals are few, so a window over them gives each slot what precedes it, and
the rows are ordered only inside their slot. A slot is a pure function of the row (literal cut points), so a task
that runs again puts its rows in the same slots.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_SLOTS = 64
MAX_SLOTS = 4096
TIE_SLOTS = 64
SLOT_ROWS = 50_000


def slot_count(df: DataFrame, rows: int | None = None) -> int:
    """As many slots as keep ``SLOT_ROWS`` rows in one, or as the session shuffles into if the rows are not counted;
    within fixed bounds."""
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if rows is None else rows // SLOT_ROWS
    return max(MIN_SLOTS, min(MAX_SLOTS, wanted))


def cut_points(df: DataFrame, sizes: Mapping[str, int]) -> dict[str, list[float]]:
    """Ascending distinct quantile cut points per numeric column: one pass, at most ``MAX_SLOTS`` numbers each."""
    def quantiles(name: str, n: int) -> Column:
        levels = ", ".join(f"{i / n!r}D" for i in range(1, n))
        return F.expr(f"percentile_approx(CAST(`{name}` AS DOUBLE), array({levels}), {20 * n})").alias(name)

    row = df.agg(*[quantiles(name, n) for name, n in sizes.items()]).first()
    return {name: sorted({c for c in row[name] or () if math.isfinite(c)} or {0.0}) for name in sizes}


def number_or_null(column: Column) -> Column:
    return F.nanvl(column.cast("double"), F.lit(None).cast("double"))


def add_slots(df: DataFrame, cuts: Mapping[str, Sequence[float]], suffix: str = "_slot") -> DataFrame:
    """Adds ``<column>_slot``: odd for a value equal to a cut point, even for the range between two of them.

    A value that many rows share is itself a cut point and so gets an (odd) slot of its own. NULL and NaN have none.
    """
    names = list(cuts)
    kept = df.columns
    raw = {name: f"__{name}_double" for name in names}
    bins = {name: f"__{name}_bin" for name in names}
    wide = df.select("*", *[number_or_null(F.col(n)).alias(raw[n]) for n in names])
    wide = Bucketizer(
        splitsArray=[[float("-inf"), *cuts[n], float("inf")] for n in names],
        inputCols=[raw[n] for n in names],
        outputCols=[bins[n] for n in names],
        handleInvalid="keep",
    ).transform(wide)
    slots = []
    for name in names:
        number = F.col(bins[name]).cast("int")
        # the whole list of cut points as one constant
        known = F.expr(f"array({', '.join(f'{float(c)!r}D' for c in cuts[name])})")
        below = F.element_at(known, number)
        slot = F.when(number == 0, 0).when(F.col(raw[name]) == below, 2 * number - 1).otherwise(2 * number)
        slots.append(F.when(F.col(raw[name]).isNotNull(), slot).cast("int").alias(name + suffix))
    return wide.select(*kept, *slots)


def running_totals(
    rows: DataFrame,
    by: Sequence[str],
    slot: Sequence[str],
    order: Sequence[Column | str],
    measures: Mapping[str, str],
) -> DataFrame:
    """Adds inclusive running sums ``measures = {new column: summed column}`` in ``order`` within ``by``.

    ``slot`` columns must not decrease along ``order``, and no key may be NULL. The totals window holds one row per
    ``by`` and slot.
    """
    by, slot = list(by), list(slot)
    inside = Window.partitionBy(*by, *slot).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy(*slot).rowsBetween(Window.unboundedPreceding, -1)
    if by:
        before = Window.partitionBy(*by).orderBy(*slot).rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*by, *slot).agg(*[F.sum(src).alias(f"__{new}") for new, src in measures.items()])
    offsets = totals.select(
        *by,
        *slot,
        *[F.coalesce(F.sum(f"__{new}").over(before), F.lit(0)).alias(f"__{new}_before") for new in measures],
    )
    # the join leaves the rows partitioned as the window below needs them
    joined = rows.join(offsets, [*by, *slot])
    kept = [c for c in rows.columns if c not in measures]
    return joined.select(
        *kept,
        *[
            (F.sum(src).over(inside) + F.col(f"__{new}_before")).alias(new)
            for new, src in measures.items()
        ],
    )


def nth_rows(
    df: DataFrame, positions: Mapping[str, Sequence[int]], rows: int, tie: str | None = None
) -> dict[str, dict[int, tuple[float, int | None]]]:
    """Per column the (value, tie) at 1-based ``positions`` when its values, NULL and NaN left out, are ordered.

    Slots are counted without moving a row; only rows of the slots that hold a position are shuffled and ordered. The
    driver gets one row per position. Without ``tie``, a value that many rows share needs no order at all.
    The input is read three times: stage it when it is costly.
    """
    names = list(positions)
    n_slots = slot_count(df, rows)
    extra = {tie: TIE_SLOTS} if tie else {}
    cuts = cut_points(df, {n: n_slots for n in names} | extra)
    slotted = add_slots(df.select(*names, *extra), cuts)

    def entry(name: str, *more: Column) -> Column:
        spread = F.when(F.col(f"{name}_slot") % 2 == 1, F.col(f"{tie}_slot")).otherwise(0) if tie else F.lit(0)
        return F.struct(F.lit(name).alias("name"), F.col(f"{name}_slot").alias("slot"), spread.alias("part"), *more)

    def long(entries: Sequence[Column]) -> DataFrame:
        return slotted.select(F.inline(F.filter(F.array(*entries), lambda e: e["slot"].isNotNull())))

    totals = long([entry(n) for n in names]).groupBy("name", "slot", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("name").orderBy("slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    asked = [(name, int(at)) for name in names for at in positions[name]]
    wanted = F.broadcast(df.sparkSession.createDataFrame(asked, "name string, position bigint"))
    inside = (F.col("position") > F.col("before")) & (F.col("position") <= F.col("before") + F.col("n"))
    # one row per position
    holding = totals.join(wanted, "name").where(inside).collect()
    entries = []
    for name in names:
        own = {(r.slot, r.part) for r in holding if r.name == name}
        chosen = F.lit(False)
        for slot, part in sorted(own):
            chosen = chosen | ((F.col(f"{name}_slot") == slot) & (entry(name)["part"] == part))
        value = number_or_null(F.col(name)).alias("value")
        held = entry(name, value, (F.col(tie) if tie else F.lit(None).cast("bigint")).alias("tie"))
        entries.append(F.when(chosen, held))
    rows_held = slotted.select(F.inline(F.filter(F.array(*entries), lambda e: e.isNotNull())))
    found: dict[str, dict[int, tuple[float, int | None]]] = {name: {} for name in names}
    if not holding:
        return found
    places = [(r.name, r.slot, r.part, int(r.position - r.before), int(r.position)) for r in holding]
    places = df.sparkSession.createDataFrame(places, "name string, slot int, part int, place int, position bigint")
    if tie:
        numbered = Window.partitionBy("name", "slot", "part").orderBy("value", "tie")
        rows_held = rows_held.withColumn("place", F.row_number().over(numbered))
        picked = rows_held.join(F.broadcast(places), ["name", "slot", "part", "place"])
    else:
        # equal values are counted, not ordered
        counted = rows_held.groupBy("name", "slot", "part", "value").agg(F.count(F.lit(1)).alias("n"))
        running = Window.partitionBy("name", "slot", "part").orderBy("value")
        counted = counted.withColumn("upto", F.sum("n").over(running)).join(F.broadcast(places), ["name", "slot", "part"])
        picked = counted.where((F.col("place") <= F.col("upto")) & (F.col("place") > F.col("upto") - F.col("n")))
        picked = picked.withColumn("tie", F.lit(None).cast("bigint"))
    for r in picked.select("name", "position", "value", "tie").collect():
        found[r.name][r.position] = (r.value, r.tie)
    return found


def ntiles(df: DataFrame, columns: Mapping[str, str], tie: str, tiles: int) -> DataFrame:
    """Adds ``columns = {new column: ordered column}``: the SQL ``ntile`` by value, missing ones last, then ``tie``.

    Only the first row of each tile is looked for; every other row is compared with those, so no row is shuffled.
    """
    keys = {new: f"__{new}_key" for new in columns}
    keyed = df.withColumns({keys[new]: order_key(F.col(source)) for new, source in columns.items()})
    rows = df.count()
    small, large = divmod(rows, tiles)
    starts = [at for j in range(1, tiles) if (at := 1 + j * small + min(j, large)) <= rows]
    edges = nth_rows(keyed, {key: starts for key in keys.values()}, rows, tie)

    def tile(key: str) -> Column:
        number = F.lit(1)
        for value, first in edges[key].values():
            reached = (F.col(key) > value) | ((F.col(key) == value) & (F.col(tie) >= first))
            number = number + reached.cast("int")
        return number

    return keyed.withColumns({new: tile(key) for new, key in keys.items()}).drop(*keys.values())


def order_key(value: Column) -> Column:
    """The value as a double that sorts missing values as the largest double, after infinity."""
    below = math.nextafter(sys.float_info.max, 0)
    number = number_or_null(value)
    return F.when(number.isNull(), sys.float_info.max).otherwise(F.least(number, F.lit(below)))


def number_rows(
    df: DataFrame, value: Column, tie: Column, position: str = "position", base: DataFrame | None = None
) -> DataFrame:
    """Adds the 1-based position of each row when ordered by ``value`` (as a double) then the unique ``tie``, ascending.

    Rows without a value come last, after infinite ones. Rows with a value of their own slot (one that many rows share)
    are spread over slots of the tie column as well.
    The input is read more than once: stage it when it is costly. ``base`` has the same rows as ``df`` in a cheaper
    form, to count them from.
    """
    kept = df.columns
    base = df if base is None else base

    def keyed(rows: DataFrame) -> DataFrame:
        return rows.select("*", order_key(value).alias("__value"), tie.cast("double").alias("__tie"))

    cuts = cut_points(keyed(base), {"__value": slot_count(df, base.count()), "__tie": TIE_SLOTS})

    def slotted(rows: DataFrame) -> DataFrame:
        spread = F.when(F.col("__value_slot") % 2 == 1, F.col("__tie_slot")).otherwise(0)
        return add_slots(keyed(rows), cuts).withColumn("__tie_slot", spread)

    slot = ["__value_slot", "__tie_slot"]
    # value slots x tie slots bounds the totals, whatever the number of rows
    totals = slotted(base).groupBy(*slot).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy(*slot).rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(totals.select(*slot, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")))
    inside = Window.partitionBy(*slot).orderBy(F.col("__value"), tie.asc())
    return slotted(df).join(offsets, slot).select(
        *kept, (F.row_number().over(inside) + F.col("__before")).cast("bigint").alias(position)
    )


def ntile_from_position(position: Column, rows: Column, tiles: int) -> Column:
    """The SQL ``ntile``: the first ``rows % tiles`` tiles hold one row more."""
    small = F.floor(rows / tiles)
    large = rows % tiles
    edge = large * (small + 1)
    return (
        F.when(position <= edge, F.floor((position - 1) / (small + 1)))
        .otherwise(large + F.floor((position - 1 - edge) / F.greatest(small, F.lit(1))))
        .cast("int")
        + 1
    )


def unpivot_features(df: DataFrame, features: Sequence[str], keep: Sequence[str], slots: bool = True) -> DataFrame:
    """One row per kept columns and feature: ``(keep…, feature, value[, slot])``; NULL and NaN are dropped."""
    fields = []
    for name in features:
        parts = [F.lit(name).alias("feature"), number_or_null(F.col(name)).alias("value")]
        if slots:
            parts.append(F.col(f"{name}_slot").alias("slot"))
        fields.append(F.struct(*parts))
    long = df.select(*keep, F.inline(F.array(*fields)))
    return long.filter(F.col("value").isNotNull())


def value_counts(df: DataFrame, features: Sequence[str], by: Sequence[str] = (), measures=None) -> DataFrame:
    """Rows per ``by``, feature, slot and distinct value, counted before anything is shuffled."""
    slotted = add_slots(df, cut_points(df, {f: slot_count(df) for f in features}))
    measures = measures or {"n": F.count(F.lit(1))}
    sources = [c for c in df.columns if c not in features]
    long = unpivot_features(slotted, features, sources)
    return long.groupBy(*by, "feature", "slot", "value").agg(*[m.alias(k) for k, m in measures.items()])


def exact_quantiles(
    df: DataFrame, features: Sequence[str], levels: Mapping[str, float], counts: DataFrame | None = None
) -> DataFrame:
    """Linear-interpolation quantiles per feature: one row per feature with a column per level and the count ``n``.

    Only distinct values with their counts are ordered, in slots; no task buffers the values of a whole feature.
    """
    counts = value_counts(df, features) if counts is None else counts
    running = running_totals(counts, ["feature"], ["slot"], ["value"], {"upto": "n"})
    sizes = counts.groupBy("feature").agg(F.sum("n").alias("size"))
    # one row per feature
    placed = running.join(F.broadcast(sizes), "feature")
    picks = []
    for name, level in levels.items():
        rank = F.lit(float(level)) * (F.col("size") - 1)
        for side, at in (("low", F.floor(rank)), ("high", F.ceil(rank))):
            here = (F.col("upto") - F.col("n") <= at) & (at < F.col("upto"))
            picks.append(F.max(F.when(here, F.col("value"))).alias(f"__{name}_{side}"))
    found = placed.groupBy("feature").agg(F.max("size").alias("n"), *picks)
    out = []
    for name, level in levels.items():
        rank = F.lit(float(level)) * (F.col("n") - 1)
        low, high = F.col(f"__{name}_low"), F.col(f"__{name}_high")
        out.append((low + (high - low) * (rank - F.floor(rank))).alias(name))
    return found.select("feature", "n", *out)
