"""Chat formatting of reply trees.

Messages with parents form trees. Self-joins that double their reach each round (a message's parent, the parent's
parent, four up, ...) give every message its root, depth and the sum of scores above it, so a thread of thousands of
replies takes a dozen rounds. Leaves are ranked within their tree by the mean score of their branch; the chosen leaves
are then walked up, again by doubling, and each path becomes one conversation.

Template: a turn is ``<s>[INST] role``, newline, text, `` [/INST]</s>``. Inside roles and texts a backslash is doubled
and a backslash is put after the first sign of each control string, so no control string of the output stems from a
text; a line end inside a role is a backslash and ``n``. ``read`` gives back the turns exactly. The loss mask is a list of spans (code points, end exclusive) that
cover the texts of assistants.

Defined cases: null text and null role count as empty; a parent that does not exist makes a root; messages of a cycle
have no leaf and form no conversation; equal branch scores go to the smaller leaf id; repeated message ids are
refused by ``reply_paths`` (the caller numbers its rows); a null score counts as 0; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage_table

LEARNER = "assistant"
#: The control strings of the template and of its kin, which texts may not contain bare.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
OPEN, CLOSE = "<s>[INST] ", " [/INST]</s>"
CONVERSATION = "tree string, leaf string, rank int, formatted string, loss array<struct<start:int,end:int>>"


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for control in CONTROLS:
        out = F.replace(out, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return out


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda sign: "\n" if sign[1] == "n" else sign[1], role, flags=re.DOTALL)


def read(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns = []
    for part in formatted.split(CLOSE)[:-1] if formatted else []:
        role, _, text = part.removeprefix(OPEN).partition("\n")
        turns.append((unescape_role(role), unescape(text)))
    return turns


def climb(messages: DataFrame) -> DataFrame:
    """(id, parent, tree, depth, total) from staged rounds: root, number of messages above, sum of scores down to each.

    A round moves only the messages that have not reached their root; each round finishes some, unless they lie in a cycle.
    """
    known = messages.select(F.col("id").alias("known_id"))
    rows = messages.select("id", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("total"))
    rows = rows.join(known, F.col("parent") == F.col("known_id"), "left").select("id", F.col("known_id").alias("parent"), "total")
    first = rows.select("*", F.col("parent").alias("up"), F.coalesce("parent", "id").alias("tree"), F.col("parent").isNotNull().cast("long").alias("depth"))
    first = stage_table(first, "climb")
    waiting, done = first.where("up IS NOT NULL"), first.where("up IS NULL")
    before, left = None, waiting.count()
    while left and left != before:
        far = done.unionByName(waiting).select(
            F.col("id").alias("up"), F.col("up").alias("far_up"), F.col("tree").alias("far_tree"), F.col("depth").alias("far_depth"), F.col("total").alias("far_total")
        )
        moved = stage_table(
            waiting.join(far, "up").select(
                "id",
                "parent",
                (F.col("total") + F.col("far_total")).alias("total"),
                F.col("far_up").alias("up"),
                F.col("far_tree").alias("tree"),
                (F.col("depth") + F.col("far_depth")).alias("depth"),
            ),
            "climb",
        )
        done, waiting = done.unionByName(moved.where("up IS NULL")), moved.where("up IS NOT NULL")
        before, left = left, waiting.count()
    return done.select("id", "parent", "tree", "depth", "total")


def reply_paths(messages: DataFrame, keep: int = 1) -> DataFrame:
    """(tree, leaf, rank, place, role, text): the best ``keep`` root-to-leaf paths of each tree.

    ``messages`` has id, parent, role, text and score; ids are unique.
    """
    nodes = climb(messages)
    leaves = nodes.join(messages.select(F.col("parent").alias("id")).where("id IS NOT NULL").distinct(), "id", "left_anti")
    mean = F.col("total") / (F.col("depth") + 1)
    ranked = leaves.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(mean.desc(), "id"))).where(F.col("rank") <= keep)
    ranked = stage_table(ranked.select("tree", F.col("id").alias("leaf"), "rank", "depth"), "leaves")
    paths = ranked.select("tree", "leaf", "rank", F.col("leaf").alias("id"), F.col("depth").alias("place"))
    longest = ranked.agg(F.max("depth")).first()[0] or 0
    jump, reach = nodes.where("parent IS NOT NULL").select("id", F.col("parent").alias("to")), 1
    while reach <= longest:
        up = paths.join(jump, "id").select("tree", "leaf", "rank", F.col("to").alias("id"), (F.col("place") - reach).alias("place"))
        paths = stage_table(paths.union(up), "paths")
        reach *= 2
        if reach <= longest:
            further = jump.select(F.col("id").alias("to"), F.col("to").alias("next"))
            jump = stage_table(jump.join(further, "to").select("id", F.col("next").alias("to")), "jumps")
    return paths.join(messages.select("id", "role", "text"), "id").select("tree", "leaf", "rank", "place", "role", "text")


def format_paths(paths: DataFrame) -> DataFrame:
    """tree, leaf, rank, formatted text and loss spans of each path."""
    role, text = escape_role(F.col("role")), escape(F.col("text"))
    turn = F.struct("place", (F.coalesce("role", F.lit("")) == LEARNER).alias("learns"), F.concat(F.lit(OPEN), role, F.lit("\n")).alias("head"), text.alias("body"))
    rows = paths.select("tree", "leaf", "rank", turn.alias("turn"), F.length("turn.head").alias("before"), F.length("turn.body").alias("inside"))
    before = Window.partitionBy("tree", "leaf", "rank").orderBy("turn.place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("before") + F.col("inside") + len(CLOSE)).over(before), F.lit(0)) + F.col("before")
    span = F.struct(start.cast("int").alias("start"), (start + F.col("inside")).cast("int").alias("end"))
    parts = rows.select("tree", "leaf", "rank", F.struct(F.col("turn.place").alias("place"), "turn.learns", F.concat("turn.head", "turn.body", F.lit(CLOSE)).alias("all"), span.alias("span")).alias("part"))
    whole = parts.groupBy("tree", "leaf", "rank").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    return whole.select(
        "tree",
        "leaf",
        "rank",
        F.concat_ws("", F.transform("parts", lambda p: p["all"])).alias("formatted"),
        F.transform(F.filter("parts", lambda p: p["learns"]), lambda p: p["span"]).alias("loss"),
    )


def digests(conversations: DataFrame) -> DataFrame:
    """The formatted conversations with what is read back from them: turns, loss text and their digests."""
    kept = [c for c in conversations.columns if c not in ("formatted", "loss")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for formatted, loss in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist(), strict=True):
                turns = read(formatted)
                learnt = "".join(unescape(formatted[s["start"] : s["end"]]) for s in loss)
                whole = "".join(f"{role}\n{text}\n" for role, text in turns)
                row = (len(turns), sha256(whole.encode()).hexdigest(), len(learnt), sha256(learnt.encode()).hexdigest(), len(formatted))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *(pa.array(c, k) for c, k in zip(out, kinds, strict=True))], [*kept, *names])

    kinds = ", ".join(f"`{c}` {conversations.schema[c].dataType.simpleString()}" for c in kept)
    found = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return conversations.mapInArrow(work, f"{kinds}, {found}")


def from_turns(turns: DataFrame) -> DataFrame:
    """Messages from rows (conv_id, turn, role, text): each replies to the row before it; row order breaks ties.

    Rows of equal turn and role are ordered by text, so the window carries the texts; it streams a conversation in order
    and sorts on disk where it must.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", "turn", "role", "text").withColumn("at", F.row_number().over(order))
    name = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    parent = F.when(F.col("at") > 1, F.concat_ws(":", name, (F.col("at") - 1).cast("string")))
    return rows.select(F.concat_ws(":", name, F.col("at").cast("string")).alias("id"), parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"), "conv_id")
