"""Chat formatting: roles of raw transcript lines by a hidden Markov model, then turns in one canonical form.

Hidden states are a role and whether a line is the first of its turn. A line shows a speaker marker (or none), how long
it is, and how it ends. Start, transition and observation probabilities are counts over all labelled lines, add-one
smoothed; they are small tables. The most likely states are found by Viterbi's algorithm as a tree of max-plus matrix
products: lines are multiplied within chunks of ``CHUNK`` source turns, chunks in groups of ``GROUP``, and so on up to one
matrix a conversation; then the best entry and exit states go down the same tree to the lines. So a conversation of any
length is many small tasks, and the result is that of one pass over it.

Cases: null texts are one empty line; null and negative turns come first; null roles don't teach; a null conversation id is a conversation of its own; rows
with the same conversation and turn follow each other in the order of their texts; other columns are not read. Without
labelled lines all probabilities are equal. A line's marker is removed where the line is found to begin a turn.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.llm.words import blocks_of
from duskwatch.session import stage

ROLES = ("system", "user", "assistant")
# Words by which transcripts mark speakers.
MARKERS = {"system": ("system", "instruction"), "user": ("user", "human", "question", "q"), "assistant": ("assistant", "ai", "bot", "answer", "a")}
MARKER = r"^\s*(?:#{1,4}\s*|\*\*|\[|<\|?)?([A-Za-z]{1,11})(?:\|?>|\]|\*\*)?\s*:\s?"
STATES = 2 * len(ROLES)  # role * 2 + (0: first line of a turn, 1: a later one)
START = STATES
CHUNK, GROUP = 64, 256
FEATURES = ("marker", "length", "ending")
SIZES = (5, 8, 4)  # values that each feature takes


def observed(line: Column) -> list[Column]:
    word = F.lower(F.regexp_extract(line, MARKER, 1))
    marker = F.when(word == "", 0)
    for k, role in enumerate(ROLES):
        marker = marker.when(word.isin(*MARKERS[role]), k + 1)
    end = F.substring(F.rtrim(line), -1, 1)
    length = F.least(F.lit(7), F.floor(F.log2(F.length(line) / 16.0 + 1)).cast("int"))
    return [
        marker.otherwise(4).alias("marker"), length.alias("length"),
        F.when(end == "?", 0).when(end.isin(".", "!"), 1).when(end == "", 2).otherwise(3).alias("ending"),
    ]


def lines_of(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text", *keep: str) -> DataFrame:
    """One row per line of each source row: conv, turn, tie (of rows with one turn), line, value and the observations."""
    tie = F.xxhash64(F.col(f"`{text}`")) if not keep else F.xxhash64(F.col(f"`{text}`"), *keep)
    rows = turns.select(F.col(f"`{conv}`").alias("conv"), F.greatest(F.coalesce(F.col(f"`{turn}`").cast("long"), F.lit(-1)), F.lit(-1)).alias("turn"), tie.alias("tie"), *keep,
                        F.posexplode(F.split(F.coalesce(F.col(f"`{text}`"), F.lit("")), "\n")).alias("line", "value"))
    return rows.select("*", *observed(F.col("value")))


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    show: list[np.ndarray]

    def matrices(self, rows: pa.Table) -> np.ndarray:
        """A max-plus matrix per line: entering by one state and leaving in another."""
        shown = sum(self.show[k][:, rows.column(f).to_numpy()] for k, f in enumerate(FEATURES)).T
        full = np.full((STATES + 1, STATES + 1), -np.inf)
        full[:STATES, :STATES], full[START, :STATES] = self.move, self.start
        out = np.full((rows.num_rows, STATES + 1, STATES + 1), -np.inf)
        out[:, :, :STATES] = full[None, :, :STATES] + shown[:, None, :]
        return out


def fit(lines: DataFrame) -> Model:
    """Count over lines that have ``role``; the driver gets one row per pair of states and per state and observation."""
    state = F.coalesce(*[F.when(F.col("role") == r, 2 * k) for k, r in enumerate(ROLES)])
    known = lines.withColumn("state", (state + (F.col("line") > 0).cast("int"))).where("state IS NOT NULL")
    # a line's predecessor is in its own source row, or the last line of the row before, whose state its role and lines tell
    inner = known.where("line > 0").select((F.col("state") - F.when(F.col("line") == 1, 1).otherwise(0)).alias("a"), F.col("state").alias("b"))
    last = known.groupBy("conv", "turn").agg(F.max("state").alias("state"), F.min("state").alias("first"))
    ahead = last.select("conv", (F.col("turn") + 1).alias("turn"), F.col("state").alias("a")).join(last.select("conv", "turn", F.col("first").alias("b")), ["conv", "turn"]).select("a", "b")
    begin = last.where("turn = 0").select(F.lit(START).alias("a"), F.col("first").alias("b"))
    moves = np.ones((STATES + 1, STATES))
    for r in inner.unionByName(ahead).unionByName(begin).groupBy("a", "b").count().collect():
        moves[r["a"], r["b"]] += r["count"]
    moves = np.log(moves / moves.sum(axis=1, keepdims=True))
    show = [np.ones((STATES, n)) for n in SIZES]
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("f"), F.col(f).alias("v")) for k, f in enumerate(FEATURES)]))
    for r in known.select("state", pairs.alias("p")).groupBy("state", "p.f", "p.v").count().collect():
        show[r["f"]][r["state"], r["v"]] += r["count"]
    return Model(moves[START], moves[:START], [np.log(s / s.sum(axis=1, keepdims=True)) for s in show])


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def matrices_of(rows: pa.Table, model: Model | None) -> np.ndarray:
    if model is not None:
        return model.matrices(rows)
    return np.frombuffer(b"".join(rows.column("matrix").to_pylist()), np.float64).reshape(-1, STATES + 1, STATES + 1)


def multiply(model: Model | None):
    """One matrix per block: the product of its rows' in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks_of(batches):
            every = matrices_of(rows, model)
            total = every[0]
            for m in every[1:]:
                total = joined(total, m)
            yield pa.RecordBatch.from_arrays([rows.column("conv").combine_chunks()[:1], rows.column("up")[:1].combine_chunks(), pa.array([total.tobytes()])], ["conv", "at", "matrix"])

    return run


def trace(model: Model | None):
    """Each row's entry and exit state on the best way through its block, whose own entry and exit are known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in blocks_of(batches):
            every = matrices_of(rows, model)
            best = np.full(STATES + 1, -np.inf)
            best[int(rows.column("enter")[0].as_py())] = 0.0
            back = []
            for m in every:
                through = best[:, None] + m
                back.append(through.argmax(axis=0))
                best = through.max(axis=0)
            leave = rows.column("leave")[0].as_py()
            exits = [int(best.argmax()) if leave is None else int(leave)]
            for choice in reversed(back):
                exits.append(int(choice[exits[-1]]))
            exits.reverse()
            named = [n for n in rows.schema.names if n not in ("enter", "leave", "matrix", "block", "up")]
            yield pa.RecordBatch.from_arrays([*[rows.column(n).combine_chunks() for n in named], pa.array(exits[:-1], pa.int32()), pa.array(exits[1:], pa.int32())], [*named, "enter", "leave"])

    return run


def in_blocks(rows: DataFrame, *order: str) -> DataFrame:
    return rows.withColumn("block", F.xxhash64("conv", "up")).repartition("block").sortWithinPartitions("block", *order)


def decode(lines: DataFrame, model: Model) -> DataFrame:
    """The lines with ``state``, their most likely one."""
    conv = lines.schema["conv"].dataType.simpleString()
    mats = f"conv {conv}, at bigint, matrix binary"
    base = lines.withColumn("up", F.floor(F.col("turn") / CHUNK).cast("long"))
    order = ("turn", "tie", "line")
    levels = [stage(in_blocks(base.select("conv", "up", *order, *FEATURES), *order).mapInArrow(multiply(model), mats), "chunks")]
    while (levels[-1].agg(F.max("at")).first()[0] or 0) > 0:  # turns below 0 stay at -1
        above = levels[-1].withColumn("up", F.floor(F.col("at") / GROUP).cast("long"))
        levels.append(stage(in_blocks(above, "at").mapInArrow(multiply(None), mats), "chunks"))
    # the topmost matrices of a conversation (at -1, for rows without turn, and 0) are one last block
    ways = levels[-1].withColumn("up", F.lit(0).cast("long")).withColumn("enter", F.lit(START)).withColumn("leave", F.lit(None).cast("int"))
    known = f"conv {conv}, at bigint, enter int, leave int"
    ends = stage(in_blocks(ways, "at").mapInArrow(trace(None), known), "ways")
    for level in reversed(levels[:-1]):
        below = with_ends(level.withColumn("up", F.floor(F.col("at") / GROUP).cast("long")), ends)
        ends = stage(in_blocks(below, "at").mapInArrow(trace(None), known), "ways")
    full = with_ends(base, ends)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in lines.schema)
    return in_blocks(full, *order).mapInArrow(trace(model), f"{fields}, enter int, leave int").drop("enter").withColumnRenamed("leave", "state")


def with_ends(rows: DataFrame, ends: DataFrame) -> DataFrame:
    keyed = ends.select(F.col("conv").alias("_conv"), F.col("at").alias("_at"), "enter", "leave")
    return rows.join(keyed, rows["conv"].eqNullSafe(F.col("_conv")) & (rows["up"] == F.col("_at"))).drop("_conv", "_at")


def turns_of(decoded: DataFrame) -> DataFrame:
    """Canonical turns: conv, begins (source turn, tie and line), role, n_lines and rendered text.

    A turn begins at a first line or where the role changes. What is open at the end of a chunk goes on in the next, so
    beginnings are carried within chunks and then from chunk to chunk.
    """
    rows = decoded.withColumn("chunk", F.floor(F.col("turn") / CHUNK)).withColumn("role_no", F.floor(F.col("state") / 2).cast("int")).withColumn("at", F.struct("turn", "tie", "line"))
    by_chunk = Window.partitionBy("conv", "chunk").orderBy("turn", "tie", "line")
    changed = (F.col("state") % 2 == 0) | (F.lag("role_no").over(by_chunk) != F.col("role_no"))
    marked = stage(rows.withColumn("begin", F.when(F.coalesce(changed, F.col("state") % 2 == 0), F.col("at"))), "decoded")
    ends = marked.groupBy("conv", "chunk").agg(F.max("begin").alias("last"), F.max_by("role_no", "at").alias("role_after"))
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    open_ = stage(ends.select(F.col("conv").alias("_conv"), F.col("chunk").alias("_chunk"), F.last("last", ignorenulls=True).over(before).alias("carried")), "open-turns")
    full = marked.join(open_, marked["conv"].eqNullSafe(F.col("_conv")) & (marked["chunk"] == F.col("_chunk")))
    begins = F.coalesce(F.last("begin", ignorenulls=True).over(by_chunk.rowsBetween(Window.unboundedPreceding, 0)), "carried", F.min("at").over(Window.partitionBy("conv", "chunk")))
    clean = F.when(F.col("state") % 2 == 0, F.regexp_replace("value", MARKER, "")).otherwise(F.col("value"))
    lines = full.select("conv", begins.alias("begins"), "at", clean.alias("value"), "role_no")
    grouped = lines.groupBy("conv", "begins").agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("lines"), F.min_by("role_no", "at").alias("role_no"))
    body = F.trim(F.array_join(F.transform("lines", lambda x: x.value), "\n"))
    role = F.element_at(F.array(*map(F.lit, ROLES)), F.col("role_no") + 1)
    return grouped.select("conv", "begins", role.alias("role"), F.size("lines").alias("n_lines"), F.concat(F.lit("<|"), role, F.lit("|>\n"), body, F.lit("\n<|end|>")).alias("rendered"))


STYLES = ("{}: ", "### {}: ", "[{}]: ", "**{}**: ")


def as_transcripts(conversations: DataFrame, unmarked: int = 10) -> DataFrame:
    """Turns as raw transcripts mark them: one style a conversation, and one turn in ``unmarked`` without a marker."""
    names = {"system": ("System", "Instruction"), "user": ("User", "Human"), "assistant": ("Assistant", "AI")}
    style = F.pmod(F.xxhash64(F.lit("style"), "conv_id"), F.lit(2 * len(STYLES)))
    mark = F.lit("")
    for k in range(2 * len(STYLES)):
        for role, words in names.items():
            mark = F.when((style == k) & (F.col("role") == role), STYLES[k // 2].format(words[k % 2])).otherwise(mark)
    bare = F.pmod(F.xxhash64(F.lit("bare"), "conv_id", "turn"), F.lit(unmarked)) == 0
    return conversations.withColumn("text", F.concat(F.when(bare, "").otherwise(mark), F.coalesce("text", F.lit(""))))
