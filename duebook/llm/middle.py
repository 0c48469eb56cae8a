"""Fill-in-middle texts assembled by a secondary sort.

A text is cut at two code points drawn from a hash of its doc_id. Its parts, cut further into chunks of bounded size,
become pieces keyed by document and position in the output. One repartition by document with a sort inside the
partitions (the DataFrame form of repartitionAndSortWithinPartitions) puts the pieces of every document in output
order, so one pass streams them into an incremental digest or joins them to the output text. From the marks met in that
stream each piece gets its place in the original text; a second sort inside the same partitions, without a shuffle,
streams the restored text into a second digest. No step holds more than a chunk of a text, but for ``outputs`` and
``restore``, which return whole texts.

Rows are told apart by the partition they are read in, their doc_id and a digest of their text, so a lost task that runs
again keys them alike, and many equal rows spread over the partitions they are read in.

Defined cases: a null text is empty; empty texts, and texts that hold a mark, stay plain; a null doc_id is hashed as
the empty number; repeated rows give repeated results; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
#: Percentages: texts that are rearranged, and those of them with the suffix first.
REARRANGED, SUFFIX_FIRST = 90, 20
#: Code points of a piece.
CHUNK = 65_536
#: Rank of a part in the original text, above the position within the part.
RANK_BITS = 40
RANKS = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}
PIECE_ROWS = 2_000

ABOUT = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
_ABOUT_TYPES = "doc_id long, n long, form string, prefix_chars long, middle_chars long"
_PIECES = f"document binary, at long, piece string, {_ABOUT_TYPES}"
_PLACED = f"document binary, place long, piece string, {_ABOUT_TYPES}, copies long, output_sha256 string"
_DIGESTS = f"{_ABOUT_TYPES}, output_sha256 string, restored_sha256 string"
_OUTPUTS = f"{_ABOUT_TYPES}, output string"


def plan(doc_id: int | None, text: str) -> tuple[str, int, int]:
    """Form of the output and the two cuts, from the hash of ``doc_id``."""
    digest = sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    one, two, three, four = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    n = len(text)
    first, second = sorted((one % (n + 1), two % (n + 1)))
    if not text or any(mark in text for mark in MARKS) or three % 100 >= REARRANGED:
        return "plain", 0, 0
    return ("spm" if four % 100 < SUFFIX_FIRST else "psm"), first, second


def parts(text: str, form: str, first: int, second: int) -> list[tuple[str, int, int]]:
    """(mark, start, end) of the parts in output order."""
    if form == "plain":
        return [("", 0, len(text))]
    prefix, middle, suffix = (PREFIX, 0, first), (MIDDLE, first, second), (SUFFIX, second, len(text))
    return [suffix, prefix, middle] if form == "spm" else [prefix, suffix, middle]


def _cut(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    partition = TaskContext.get().partitionId().to_bytes(4, "big")
    for batch in slices(batches, "text"):
        rows = []
        for doc_id, raw in zip(batch.column("doc_id").to_pylist(), texts(batch.column("text")), strict=True):
            text = raw.decode()
            form, first, second = plan(doc_id, text)
            cuts = (None, None) if form == "plain" else (first, second - first)
            document = partition + b"%d:" % (-1 if doc_id is None else doc_id) + xxhash.xxh128_digest(raw)
            at = 0
            for mark, start, end in parts(text, form, first, second):
                for place in range(start, max(end, start + 1), chunk):
                    piece = (mark if place == start else "") + text[place : min(place + chunk, end)]
                    rows.append((document, at, piece, doc_id, len(text), form, *cuts))
                    at += len(piece)
            if len(rows) >= PIECE_ROWS:
                yield _batch(rows, _CUT_SCHEMA)
                rows = []
        if rows:
            yield _batch(rows, _CUT_SCHEMA)


_KINDS = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}


def _schema(fields: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (field.split() for field in fields.split(", "))])


_CUT_SCHEMA, _PLACED_SCHEMA, _DIGESTS_SCHEMA, _OUTPUTS_SCHEMA = map(_schema, (_PIECES, _PLACED, _DIGESTS, _OUTPUTS))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def cut_pieces(documents: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The pieces of every document, those of one document together and in the order of its output."""
    pieces = documents.select("doc_id", "text").mapInArrow(lambda batches: _cut(batches, chunk), _PIECES)
    return pieces.repartition("document").sortWithinPartitions("document", "at")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in slices(batches, "piece"):
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, bool, bool]]:
    """Each row, whether it begins a document, and whether it repeats the row before it."""
    before = (None, None)
    for row in _rows(batches):
        yield row, row[0] != before[0], row[:2] == before
        before = row[:2]


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, last, digest, copies, rank, offset = [], None, None, 0, 0, 0

    def whole() -> tuple:
        return (last[0], -1, "", *last[3:8], copies, digest.hexdigest())

    for row, new, again in _groups(batches):
        if again:
            copies += row[1] == 0
            continue
        if new:
            if last is not None:
                out.append(whole())
            digest, copies, rank, offset = sha256(), 1, 0, 0
        last, piece = row, row[2]
        digest.update(piece.encode())
        if row[5] != "plain" and piece[:3] in RANKS:
            rank, offset, piece = RANKS[piece[:3]], 0, piece[3:]
        out.append((row[0], rank << RANK_BITS | offset, piece, *row[3:8], None, None))
        offset += len(piece)
        if len(out) >= PIECE_ROWS:
            yield _batch(out, _PLACED_SCHEMA)
            out = []
    if last is not None:
        out.append(whole())
        yield _batch(out, _PLACED_SCHEMA)


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, head, digest = [], None, None
    for row in _rows(batches):
        if row[1] < 0:
            if head is not None:
                out += [(*head[3:8], head[9], digest.hexdigest())] * head[8]
            head, digest = row, sha256()
            if len(out) >= PIECE_ROWS:
                yield _batch(out, _DIGESTS_SCHEMA)
                out = []
        else:
            digest.update(row[2].encode())
    if head is not None:
        out += [(*head[3:8], head[9], digest.hexdigest())] * head[8]
    if out:
        yield _batch(out, _DIGESTS_SCHEMA)


def digests(pieces: DataFrame) -> DataFrame:
    """Per document the digest of its output and that of the text restored from it; texts stay in pieces."""
    placed = pieces.mapInArrow(_place, _PLACED).sortWithinPartitions("document", "place")
    return placed.mapInArrow(_restored, _DIGESTS)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, last, copies = [], None, 0
    for row, new, again in _groups(batches):
        if again:
            copies += row[1] == 0
            continue
        if new and last is not None:
            yield _batch([(*last[3:8], "".join(held))] * copies, _OUTPUTS_SCHEMA)
            held = []
        if new:
            copies = 1
        last = row
        held.append(row[2])
    if last is not None:
        yield _batch([(*last[3:8], "".join(held))] * copies, _OUTPUTS_SCHEMA)


def outputs(pieces: DataFrame) -> DataFrame:
    """Per document its whole output text."""
    return pieces.mapInArrow(_joined, _OUTPUTS)


def restore(outputs: DataFrame) -> DataFrame:
    """``outputs`` (form, output, ...) with the original ``text``, found from form and output alone."""
    inside = {mark: F.expr(f"instr(output, '{mark}')") for mark in MARKS}
    upto = {
        "psm": {PREFIX: inside[SUFFIX], SUFFIX: inside[MIDDLE], MIDDLE: None},
        "spm": {SUFFIX: inside[PREFIX], PREFIX: inside[MIDDLE], MIDDLE: None},
    }
    output = F.col("output")

    def part(form: str, mark: str):
        end = upto[form][mark]
        start = inside[mark] + len(mark)
        return output.substr(start, (F.length(output) + 1 if end is None else end) - start)

    whole = {form: F.concat(*[part(form, mark) for mark in (PREFIX, MIDDLE, SUFFIX)]) for form in upto}
    text = F.when(F.col("form") == "psm", whole["psm"]).when(F.col("form") == "spm", whole["spm"]).otherwise(output)
    return outputs.withColumn("text", text)
