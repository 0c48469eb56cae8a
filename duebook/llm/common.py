"""Helpers that the operators of this folder share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from duebook.session import workspace

#: Rows of a batch that one step of a Python loop looks at, and the text bytes after which it stops earlier.
SLICE_ROWS, SLICE_BYTES = 2_000, 8_000_000


#: Numbers that ``few_cells`` has in one row.
PACKED = 4_096
#: Bits of a key filter: a power of two from the first number to the second (8 MB), ten or more a key while they last.
FILTER_BITS = (1 << 15, 1 << 26)
#: Bits of one row that a key filter is gathered in, as many as ``bitmap_construct_agg`` takes.
BITMAP = 32_768


#: Rows of an Arrow batch: texts can be long, and a batch lies in memory twice.
BATCH_ROWS = 1_000


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """A given table, reduced to ``columns`` where some are named; the session's Arrow batches become small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    frame = spark.read.parquet(f"{folder}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def stage_table(frame: DataFrame, purpose: str) -> DataFrame:
    """Write ``frame`` as Parquet to the shared folder and read it back: lineage is cut, later passes prune columns."""
    path = workspace(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def few_rows(frame: DataFrame, bound: int) -> list[Row]:
    """The rows of a small result. Fetches no more than ``bound`` and one row, and raises if there are more."""
    rows = frame.take(bound + 1)
    if len(rows) > bound:
        raise ValueError(f"more than {bound} rows for the driver")
    return rows


def few_cells(cells: DataFrame, by: list[str], place: str, value: str, bound: int) -> list[Row]:
    """A small table of numbers by ``place`` (from 0), as rows of two lists for each ``by``: rows of their own take much of the driver's memory."""
    cell = F.sort_array(F.collect_list(F.struct(place, value))).alias("cells")
    packed = cells.groupBy(*by, F.floor(F.col(place) / PACKED).alias("part")).agg(cell)
    return few_rows(packed.select(*by, f"cells.{place}", f"cells.{value}"), -(-bound // PACKED))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key), F.xxhash64(key, F.lit(1))]


def key_filter(keys: DataFrame) -> Callable[[Column], Column]:
    """A condition that holds for each key in the only column of ``keys``, and by chance for few others.

    A Bloom filter of four hashes: no key fails, and where the keys are many for the bits, more others hold.
    """
    (field,) = keys.schema
    n = keys.count()
    if not n:
        return lambda key: F.lit(False)
    size = min(max(1 << (10 * n - 1).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
    places = [F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(size - 1)) for h in _hashes(F.col(field.name)) for shift in (0, 32)]
    each = keys.select(F.explode(F.array(*places)).alias("place"))
    maps = each.groupBy(F.floor(F.col("place") / BITMAP).alias("part")).agg(F.bitmap_construct_agg(F.col("place") % BITMAP).alias("bits"))
    bits = np.zeros((size // BITMAP, BITMAP // 8), np.uint8)
    for row in few_rows(maps, len(bits)):
        bits[row.part] = np.frombuffer(row.bits, np.uint8)
    bits = bits.ravel()

    def holds(first: pa.Array, second: pa.Array) -> pa.Array:
        found = np.ones(len(first), np.uint8)
        for hashes in (first, second):
            for shift in (0, 32):
                place = (hashes.to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(shift)) & np.uint64(size - 1)
                found &= bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1
        return pa.array(found.astype(bool))

    check = F.arrow_udf(holds, "boolean")
    return lambda key: check(*_hashes(key.try_cast(field.dataType)))


def sifted(frame: DataFrame, keys: DataFrame, among: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of ``frame`` whose key is in the only column of ``keys`` for certain, those that may be, and those that are not.

    Only keys are shuffled: a second filter has the keys that hold by chance, so rows that pass the first one alone are
    certain, and few pass both. ``among`` has the keys of ``frame``, where they can be read for less. Keys may be null.
    """
    (name,) = keys.columns
    likely = key_filter(keys)
    others = (frame if among is None else among).select(name).where(likely(F.col(name))).distinct()
    wrong = key_filter(stage_table(others.join(keys, name, "left_anti"), "held-by-chance"))
    first, second = likely(F.col(name)), wrong(F.col(name))
    return frame.where(first & ~second), frame.where(first & second), frame.where(~first)


def rows_with(frame: DataFrame, keys: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """The left-semi join of ``frame`` with ``keys`` (one column), which shuffles few rows of ``frame``; null has no partner."""
    certain, unsure, _ = sifted(frame, keys, among)
    return certain.union(unsure.join(keys, keys.columns[0], "left_semi").select(*frame.columns))


def rows_without(frame: DataFrame, keys: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """The left-anti join of ``frame`` with ``keys``, likewise."""
    _, unsure, outside = sifted(frame, keys, among)
    return outside.union(unsure.join(keys, keys.columns[0], "left_anti").select(*frame.columns))


def texts(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column; null counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds few rows and, but for one long text, few bytes of ``column``."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(total, total[start] + SLICE_BYTES, side="right")) - 1
            end = max(start + 1, min(end, start + SLICE_ROWS, batch.num_rows))
            yield batch.slice(start, end - start)
            start = end
    pa.default_memory_pool().release_unused()


def crc_remainder(column: str, modulus: int):
    """crc32 of the value as text, modulo ``modulus``; null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def labelled_sample(labels: DataFrame, columns: list[str], limit: int) -> DataFrame:
    """About ``limit`` labelled rows, those of low hash of doc_id, or all where there are fewer; one row per document.

    The hash cut keeps a share of limit / all documents, so the size leaves the limit by chance only (by its root).
    """
    known = labels.where(F.col("doc_id").isNotNull())
    one = known.groupBy("doc_id").agg(*[F.max(c).alias(c) for c in columns]) if columns else known.select("doc_id").distinct()
    total = one.count()
    if total <= limit:
        return one
    return one.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int((1 << 40) * limit / total))
