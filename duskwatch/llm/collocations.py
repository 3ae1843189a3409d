"""Phrase collocations by SON partitioning: shards are mined completely at lowered support, then candidates are counted.

Texts are cut at ``.,;:!?`` and line breaks into pieces, those at spaces and tabs into words, ASCII lower-cased. A phrase
of 2 to 5 words that occurs ``support`` times in a language occurs support / shards times in one of ``shards`` shards at
least, whatever their sizes. So each shard, the input partitions of one number modulo ``shards``, is mined completely at
that support, in three levels: pairs of words that are frequent, triples whose pairs are frequent in a shard, then runs
of four and five whose triples are. The phrases frequent in any shard are the candidates, and a last pass over the texts
counts them all. The shards' number is fixed, so their support is not lowered as the input grows; a shard of many
partitions is counted by Spark, not in one task.

What tasks test words and phrases against is a bit table of fixed size. It lets a few others through, which costs work
only: counts of words and of candidates are those of whole texts, and partial counts of a task are kept by 64-bit hash.

Cases: a null text is empty, a null language is ``und``; repeated rows count as often as they come; a phrase never
crosses a piece; words of any length are kept whole; an empty table has no phrases. Only text and language are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.llm import words as W
from duskwatch.session import stage

SHARDS = 16
LONGEST = 5
TALLY = 1 << 21  # different phrases that a task counts before it passes the counts on
LABELS = 1 << 17  # the same, where it holds their texts

BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
IN_WORD = ~BREAK
IN_WORD[[0x20, 0x09]] = False


class Text(NamedTuple):
    """Words of some texts with their hashes, each word's language salt, and the range of words of each piece."""

    ws: W.Words
    hashes: np.ndarray
    salts: np.ndarray
    doc: np.ndarray
    ptr: np.ndarray

    def starts(self, length: int) -> np.ndarray:
        """The words at which a run of ``length`` words fits into its piece."""
        at = np.arange(len(self.hashes))
        return at[at + length <= np.repeat(self.ptr[1:], np.diff(self.ptr))]

    def keys(self, at: np.ndarray, length: int) -> np.ndarray:
        total = self.salts[at]
        for i in range(length):
            total = (total + self.hashes[at + i]) * W.BASE
        return W.mix(total)

    def runs(self, length: int, base: int, inside: np.ndarray) -> np.ndarray:
        """Starts of runs all of whose parts of ``base`` words are inside."""
        at = self.starts(length)
        for i in range(length - base + 1):
            at = at[inside[at + i]]
        return at


def read(batch: pa.RecordBatch) -> Text:
    ws = W.of_texts(batch.column("text"), IN_WORD)
    doc = np.repeat(np.arange(batch.num_rows), np.diff(ws.ptr))
    breaks = np.concatenate(([0], np.cumsum(BREAK[ws.data])))
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (breaks[ws.starts[1:]] != breaks[ws.ends[:-1]])
    langs = batch.column("lang").dictionary_encode()
    of_lang = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest()) for x in langs.dictionary.to_pylist()], np.uint64)
    salts = of_lang[langs.indices.to_numpy()][doc] if len(of_lang) else np.zeros(0, np.uint64)
    return Text(ws, ws.hashes(), salts, doc, np.append(np.flatnonzero(new), len(doc)))


def inside_of(text: Text, words: W.BitTable, candidates: W.BitTable | None, upto: int) -> np.ndarray:
    """For each word: does a frequent word (``upto`` 1), or a candidate of ``upto`` words, begin there?"""
    inside = np.zeros(len(text.hashes) + LONGEST, bool)
    at = np.arange(len(text.hashes))
    inside[at[words.has(text.keys(at, 1))]] = True
    for length in range(2, upto + 1):
        at = text.runs(length, length - 1, inside)
        inside = np.zeros(len(inside), bool)
        inside[at[candidates.has(text.keys(at, length))]] = True
    return inside


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def mined(lengths: tuple[int, ...], words, candidates, shards: int):
    """Counts of a task's runs of these lengths whose shorter parts are candidates, by shard and key."""
    base = lengths[0] - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() % shards
        parts, held, new = [], 0, 0

        def passed(keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            for i in range(0, len(keys), 1 << 16):
                k, c = keys[i : i + (1 << 16)].view(np.int64), counts[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(np.full(len(k), shard, np.int32)), pa.array(c)], ["key", "shard", "n"])

        for batch in W.pieces(batches, "text"):
            text = read(batch)
            inside = inside_of(text, words.value, candidates and candidates.value, base)
            for length in lengths:
                keys, counts = np.unique(text.keys(text.runs(length, base, inside), length), return_counts=True)
                parts.append((keys, counts))
                new += len(keys)
            if new > TALLY // 2:
                parts, new = [merged(parts)], 0
                held = len(parts[0][0])
                if held > TALLY // 2:
                    yield from passed(*parts[0])
                    parts = []
        if parts:
            yield from passed(*merged(parts))

    return run


def labelled(words, candidates, longest: int):
    """A task's counts of all words (without tables) or of the candidates, by language and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, list] = {}

        def passed() -> pa.RecordBatch:
            lang, phrase, length, n = zip(*counts.values()) if counts else ((), (), (), ())
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(phrase, pa.string()), pa.array(length, pa.int32()), pa.array(n, pa.int64())], ["lang", "phrase", "words", "n"])

        for batch in W.pieces(batches, "text"):
            text, lang = read(batch), batch.column("lang")
            found = []
            if words is None:
                found.append((1, np.arange(len(text.hashes))))
            else:
                inside = inside_of(text, words.value, None, 1)
                for length in range(2, longest + 1):
                    at = text.runs(length, length - 1, inside)
                    at = at[candidates.value.has(text.keys(at, length))]
                    inside = np.zeros(len(inside), bool)
                    inside[at] = True
                    found.append((length, at))
            for length, at in found:
                keys, first, times = np.unique(text.keys(at, length), return_index=True, return_counts=True)
                for key, i, n in zip(keys.tolist(), at[first].tolist(), times.tolist()):
                    have = counts.get(key)
                    if have is None:
                        counts[key] = [lang[int(text.doc[i])].as_py(), text.ws.joined(i, length), length, n]
                    else:
                        have[3] += n
            if len(counts) > LABELS:
                yield passed()
                counts.clear()
        yield passed()

    return run


def keyed(words: DataFrame) -> DataFrame:
    """The key of each (lang, phrase) of one word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, "text"):
            text = read(batch)
            yield pa.RecordBatch.from_arrays([pa.array(text.keys(np.arange(len(text.hashes)), 1).view(np.int64))], ["key"])

    return words.select("lang", F.col("phrase").alias("text")).mapInArrow(run, "key bigint")


def count_phrases(docs: DataFrame, *, text: str = "text", lang: str = "lang", support: int = 100, longest: int = LONGEST, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """All words (lang, phrase, n), and all phrases of 2 to ``longest`` (2 to 5) words with ``support`` occurrences (lang, phrase, words, n)."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words")
    rows = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))
    share = lambda value: rows.sparkSession.sparkContext.broadcast(value)  # noqa: E731  a table of fixed size
    counted = "lang string, phrase string, words int, n bigint"
    words = stage(rows.mapInArrow(labelled(None, None, 1), counted).groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "words")
    frequent = share(W.BitTable.of(keyed(words.where(F.col("n") >= support))))
    candidates, levels = None, []
    for lengths in ((2,), (3,), (4, 5)):
        lengths = tuple(n for n in lengths if n <= longest)
        if lengths:
            local = rows.mapInArrow(mined(lengths, frequent, candidates, shards), "key bigint, shard int, n bigint").groupBy("shard", "key").agg(F.sum("n").alias("n"))
            levels.append(stage(local.where(F.col("n") * shards >= support).select("key").distinct(), "candidates"))
            union = levels[0]
            for level in levels[1:]:
                union = union.unionByName(level)
            candidates = share(W.BitTable.of(union))
    found = rows.mapInArrow(labelled(frequent, candidates, longest), counted).groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
    return words, stage(found.where(F.col("n") >= support), "phrases")


SCORE = "CAST(a AS DECIMAL(19,0)) * CAST(n AS DECIMAL(19,0)) * CAST(1000 AS DECIMAL(4,0)) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"


def collocations(docs: DataFrame, *, support: int = 100, cover: int = 100, top: int = 2000, **options) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n and score.

    The score is floor(1000 a n / (l r)) at the cut with the lowest one, exact for products of 38 digits and an error beyond. A phrase inside a longer frequent one with
    ``cover`` percent of its occurrences or more is dropped.
    """
    words, phrases = count_phrases(docs, support=support, **options)
    totals = stage(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    known = stage(words.where(F.col("n") >= support).select("lang", "phrase", "n").unionByName(phrases.select("lang", "phrase", "n")), "known")
    split = phrases.withColumn("parts", F.split("phrase", " "))

    def run(start: Column, length: Column) -> Column:
        return F.array_join(F.slice("parts", start, length), " ")

    cuts = split.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("n").alias("a"), "k", run(F.lit(1), F.col("k")).alias("head"), run(F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"))
    heads, tails = known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l")), known.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang").withColumn("score", F.expr(SCORE))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    spans = F.flatten(F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda s: F.transform(
        F.sequence(F.lit(2), F.greatest(F.lit(2), F.least(F.col("words") - s + 1, F.col("words") - 1))), lambda m: F.struct(s.alias("s"), m.alias("m")))))
    inner = split.where("words > 2").select("lang", "n", "parts", F.explode(spans).alias("span"))
    covers = inner.groupBy("lang", run(F.col("span.s"), F.col("span.m")).alias("phrase")).agg(F.max("n").alias("longer"))
    free = best.join(covers, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (cover * F.col("a") > 100 * F.col("longer")))
    free = free.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = free.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
