"""How far the sources of a language differ in their terms, by hash-consed segment trees over term ids.

Terms are runs of letters, ASCII lower-cased; a language keeps those in at least ``min_docs`` of its documents. A group is
a source within a language. A group, and each language as a whole, gives a kept term the whole number
p = 1 + floor(10^9 (count + 1) / (N + V)), N its count of all kept terms and V their number. The divergence of one from
another is the sum of floor((p - q)^2 / q).

Term ids are a block and a place in it: a block holds some ``BLOCK`` terms by hash, the frequent ones first, so that the
rare ones, whose counts agree in most groups, are neighbours. A group's counts in a block make a segment tree of nodes
(left, right), and equal subtrees are one node, in all groups of a block. Two trees are walked at the same time,
level by level from their roots: equal pairs of nodes become one pair that counts as often as it occurs, so a pair is
priced once, and two empty halves cost one step. The prices of blocks are summed by Spark. Sources of one language meet
in cells of some ``SIDE`` sources a side, by hash, so a task holds a bounded number of trees however many there are.

A first pass counts each term's documents, a second one the occurrences of the terms kept, which tasks know by a bit table of
fixed size; both by 64-bit keys of language and term, so a term's text is sent once a task and only if it is kept.

Cases: null text, language and source are empty; a group without kept terms has N = 0 and equal p for all terms, one in
a language without kept terms has value 0 to all others; repeated rows are documents of their own; an empty table has
no groups. Only text, language and source are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.llm import words as W
from duskwatch.session import stage

UNIT = 1_000_000_000
LOW = (1 << 32) - 1
BLOCK = 1 << 12  # terms
SIDE = 32  # sources on a side of a cell
HELD = 1 << 20  # different keys that a task counts before it passes the counts on
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def salts_of(names: list[str]) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest()) for x in names], np.uint64)


class Terms(NamedTuple):
    """Words of some texts with their language's key, and each word's document."""

    ws: W.Words
    keys: np.ndarray
    doc: np.ndarray


def read(batch: pa.RecordBatch) -> Terms:
    ws = W.of_texts(batch.column("text"), LETTERS)
    doc = np.repeat(np.arange(batch.num_rows), np.diff(ws.ptr))
    langs = batch.column("lang").dictionary_encode()
    salt = salts_of(langs.dictionary.to_pylist())[langs.indices.to_numpy()] if batch.num_rows else np.zeros(0, np.uint64)
    return Terms(ws, W.mix(ws.hashes() ^ salt[doc]), doc)


def summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Columns of numbers, of which the last is summed for each value of the others."""
    columns = [np.concatenate(c) for c in zip(*parts)]
    mark = columns[0].astype(np.uint64)
    for c in columns[1:-1]:
        mark = W.mix(mark * W.BASE + c.astype(np.uint64))
    order = np.argsort(mark)
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:-1]])
    first = np.flatnonzero(new)
    return (*[c[first] for c in columns[:-1]], np.add.reduceat(columns[-1], first) if len(first) else columns[-1])


def tallied(batches: Iterator[pa.RecordBatch], count) -> Iterator[tuple[np.ndarray, ...]]:
    """The sums of ``count(batch)`` over batches, passed on whenever many different ones are held."""
    parts, new = [], 0
    for batch in W.pieces(batches, "text"):
        parts.append(count(batch))
        new += len(parts[-1][0])
        if new > HELD:
            parts = [summed(parts)]
            new = 0
            if len(parts[0][0]) > HELD:
                yield parts.pop()
    if parts:
        yield summed(parts)


def doc_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's number of documents for each term's key."""

    def count(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        terms = read(batch)
        keys, at = np.unique(terms.keys, return_inverse=True)
        pairs = np.unique(at * batch.num_rows + terms.doc)
        return keys, np.bincount(pairs // max(batch.num_rows, 1), minlength=len(keys))

    for keys, docs in tallied(batches, count):
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(docs)], ["key", "docs"])


def texts_at(ws: W.Words, at: np.ndarray) -> pa.Array:
    """The texts of some words."""
    size = ws.ends[at] - ws.starts[at]
    ends = np.cumsum(size)
    data = ws.data[np.repeat(ws.starts[at] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
    offsets = np.concatenate(([0], ends)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.string())


def kept_counts(table):
    """A task's occurrences of listed terms by group (lang, source, key, n), each of its groups, and the text of each term's key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], int] = {}
        known = [np.zeros(0, np.uint64)]  # keys whose texts have been sent, in order
        texts: list[pa.RecordBatch] = []

        names, kinds = ("lang", "source", "key", "n", "term"), (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())

        def out(size: int, **columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(columns[c], k) if c in columns else pa.nulls(size, k) for c, k in zip(names, kinds)], names)

        def count(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
            pairs = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            group = np.array([groups.setdefault(pair, len(groups)) for pair in pairs], np.int64)
            terms = read(batch)
            at = np.flatnonzero(table.value.has(terms.keys))
            keys, first, of = np.unique(terms.keys[at], return_index=True, return_inverse=True)
            spot = np.minimum(np.searchsorted(known[0], keys), max(len(known[0]) - 1, 0))
            new = known[0][spot] != keys if len(known[0]) else np.ones(len(keys), bool)
            if new.any():
                found = at[first[new]]
                langs = batch.column("lang").take(pa.array(terms.doc[found]))
                texts.append(out(len(found), lang=langs, key=keys[new].view(np.int64), term=texts_at(terms.ws, found)))
                known[0] = np.sort(np.concatenate((known[0], keys[new])))
            pairs, n = np.unique(of * len(groups) + group[terms.doc[at]], return_counts=True)
            return pairs % len(groups), keys[pairs // len(groups)], n

        for group, keys, n in tallied(batches, count):
            langs, sources = (pa.array([pair[i] for pair in groups], pa.string()) for i in (0, 1))
            for i in range(0, len(keys), 1 << 16):
                some, held = pa.array(group[i : i + (1 << 16)]), keys[i : i + (1 << 16)].view(np.int64)
                yield out(len(held), lang=langs.take(some), source=sources.take(some), key=held, n=n[i : i + (1 << 16)])
            yield from texts
            texts.clear()
            if len(known[0]) > HELD:
                known[0] = known[0][:0]
        yield from texts
        yield out(len(groups), lang=[x for x, _ in groups], source=[x for _, x in groups])

    return run


class Trees:
    """Nodes of segment trees: equal counts, and equal pairs of nodes, are one node."""

    def __init__(self):
        self.counts: dict[int, int] = {}
        self.values: list[int] = []
        self.inner: list[dict[int, int]] = []
        self.halves: list[list[int]] = []  # of each level's nodes: left << 32 | right
        self.arrays: dict[int, np.ndarray] = {}

    def leaf(self, count: int) -> int:
        node = self.counts.setdefault(count, len(self.values))
        if node == len(self.values):
            self.values.append(count)
        return node

    def build(self, counts: np.ndarray) -> int:
        """The root of a tree over counts, whose number is a power of two."""
        different, at = np.unique(counts, return_inverse=True)
        nodes = np.array([self.leaf(int(c)) for c in different], np.int64)[at]
        level = 0
        while len(nodes) > 1:
            if level == len(self.inner):
                self.inner.append({})
                self.halves.append([])
            known, halves = self.inner[level], self.halves[level]
            pairs, at = np.unique(nodes[0::2] << 32 | nodes[1::2], return_inverse=True)
            own = []
            for pair in pairs.tolist():
                node = known.setdefault(pair, len(halves))
                if node == len(halves):
                    halves.append(pair)
                own.append(node)
            nodes = np.array(own, np.int64)[at.ravel()]
            level += 1
        return int(nodes[0])

    def matches(self, a: int, b: int, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which leaf nodes meet in two trees and how often: equal pairs of nodes are walked once."""
        x, y, times = np.array([a]), np.array([b]), np.array([1])
        for level in range(depth - 1, -1, -1):
            halves = self.halves_at(level)
            left, right = halves[x], halves[y]
            pairs = np.concatenate((left >> 32 << 32 | right >> 32, (left & LOW) << 32 | right & LOW))
            pairs, at = np.unique(pairs, return_inverse=True)
            times = np.bincount(at, np.concatenate((times, times)), len(pairs)).astype(np.int64)
            x, y = pairs >> 32, pairs & LOW
        return x, y, times

    def halves_at(self, level: int) -> np.ndarray:
        if len(self.arrays.get(level, ())) != len(self.halves[level]):
            self.arrays[level] = np.array(self.halves[level], np.int64)
        return self.arrays[level]


def weights(counts: list[int], total: int, terms: int) -> np.ndarray:
    return np.array([1 + UNIT * (c + 1) // (total + terms) for c in counts], np.int64)


def priced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both divergences of all pairs of sources that meet in a cell, over the cell's block."""
    for cell in cells_of(batches):
        trees, size = Trees(), cell[0]["size"]
        depth = max(size - 1, 0).bit_length()
        roots = []
        for row in cell:
            counts = np.full(1 << depth, -1, np.int64)  # -1: no term
            counts[:size] = 0
            counts[np.array(row["places"], np.int64)] = row["counts"]
            roots.append(trees.build(counts))
        p_of_leaf = [weights(trees.values, row["total"], row["terms"]) for row in cell]
        out: list[tuple] = []
        for i, x in enumerate(cell):
            for j, y in enumerate(cell):
                if (x["part"] == 0 and y["part"] == 0 and j <= i) or x["part"] == 2 or y["part"] == 1:
                    continue
                a, b, times = trees.matches(roots[i], roots[j], depth)
                p, q, times = p_of_leaf[i][a], p_of_leaf[j][b], np.where(a == trees.counts.get(-1), 0, times)
                squares = (p - q) ** 2  # below 10^18 each, and the sums below (10^9 + V)^2
                here, there = int((times * (squares // q)).sum()), int((times * (squares // p)).sum())
                out += [(x["lang"], x["source"], y["source"], here), (x["lang"], y["source"], x["source"], there)]
        if out:
            lang, source, item, value = zip(*out)
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.string()) for c in (lang, source, item)], pa.array(value, pa.int64())], ["lang", "source", "item", "value"])


def cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of a sorted partition, one list for each cell."""
    held: list[dict] = []
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            for row in batch.slice(at, 64).to_pylist():
                if held and row["cell"] != held[0]["cell"]:
                    yield held
                    held = []
                held.append(row)
    if held:
        yield held


def p_of(count: str, total: str) -> Column:
    long = f"CAST((CAST({count} AS DECIMAL(19,0)) + 1) * CAST({UNIT} AS DECIMAL(10,0)) div (CAST({total} AS DECIMAL(19,0)) + CAST(terms AS DECIMAL(19,0))) AS BIGINT)"
    return F.expr(f"1 + CASE WHEN {count} < 9000000000 THEN {UNIT} * ({count} + 1) div ({total} + terms) ELSE {long} END")


def divergences(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part, item, value and rank: of part ``pair`` each other source, of part ``term`` the ``top`` terms above the language's."""
    empty = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(empty(lang).alias("lang"), empty(source).alias("source"), F.col(f"`{text}`").alias("text"))
    frequent = rows.mapInArrow(doc_counts, "key bigint, docs bigint").groupBy("key").agg(F.sum("docs").alias("docs"))
    frequent = stage(frequent.where(F.col("docs") >= min_docs).select("key"), "kept-keys")
    table = rows.sparkSession.sparkContext.broadcast(W.BitTable.of(frequent))
    found = stage(rows.mapInArrow(kept_counts(table), "lang string, source string, key bigint, n bigint, term string"), "kept-found")
    counts = stage(found.where("n IS NOT NULL").groupBy("lang", "source", "key").agg(F.sum("n").alias("n")).join(frequent, "key", "left_semi"), "kept-counts")
    totals_of = counts.groupBy("lang", "key").agg(F.sum("n").alias("lang_n"))
    sizes_of = totals_of.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = stage(sizes_of, "lang-totals")
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    all_groups = found.where("key IS NULL").select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(totals, "lang", "left")
    groups = all_groups.select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "terms", "lang_total")])
    sources = groups.groupBy("lang").agg(F.ceil(F.count("*") / SIDE).cast("int").alias("sides"))
    groups = stage(groups.join(sources, "lang").withColumn("side", F.pmod(F.xxhash64("source"), F.col("sides")).cast("int")), "groups")

    # pairs: a tree for each group and block, then cells of sources by block
    blocks = totals.select("lang", F.ceil(F.col("terms") / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    place = F.row_number().over(Window.partitionBy("lang", "block").orderBy(F.desc("lang_n"), "key")) - 1
    placed = stage(totals_of.join(blocks, "lang").withColumn("block", block).withColumn("place", place).select("lang", "key", "lang_n", "block", "place"), "places")
    sizes = placed.groupBy("lang", "block").agg(F.count("*").cast("int").alias("size"))
    own = stage(counts.join(placed, ["lang", "key"]), "placed-counts")
    leaves = own.groupBy("lang", "source", "block").agg(F.collect_list(F.struct("place", "n")).alias("leaves"))
    everywhere = groups.where("terms > 0").join(sizes, "lang").join(leaves, ["lang", "source", "block"], "left")
    met = everywhere.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
    low, high = F.least("side", "other"), F.greatest("side", "other")
    part = F.when(low == high, 0).when(F.col("side") == low, 1).otherwise(2)
    none = F.array().cast("array<bigint>")
    dealt = met.select(
        F.struct("lang", "block", low.alias("low"), high.alias("high")).alias("cell"), part.alias("part"), "lang", "source", "total", "terms", "size",
        F.coalesce(F.transform("leaves", lambda x: x.place.cast("long")), none).alias("places"), F.coalesce(F.transform("leaves", lambda x: x.n), none).alias("counts"),
    )
    dealt = dealt.withColumn("cell", F.to_json("cell")).repartition("cell").sortWithinPartitions("cell", "source")
    sums = dealt.mapInArrow(priced, "lang string, source string, item string, value bigint").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    names = groups.where("terms = 0").select("lang", "source")
    without = names.join(names.withColumnRenamed("source", "item"), "lang").where("source <> item").withColumn("value", F.lit(0).cast("long"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = sums.unionByName(without).withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))

    # terms: the group's share above the language's; texts come to those that may rank
    given = groups.select("lang", "source", "total", "terms", "lang_total")
    shares = own.join(given, ["lang", "source"]).select("lang", "source", "key", p_of("n", "total").alias("p"), p_of("lang_n", "lang_total").alias("q"))
    above = shares.where("p > q").select("lang", "source", "key", F.expr("(p - q) * (p - q) div q").alias("value"))
    some = above.withColumn("rank", F.rank().over(Window.partitionBy("lang", "source").orderBy(F.desc("value")))).where(F.col("rank") <= top)
    texts = found.where("term IS NOT NULL").groupBy("lang", "key").agg(F.min("term").alias("item"))
    terms = some.drop("rank").join(texts, ["lang", "key"]).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(*columns).unionByName(terms.select(*columns))
