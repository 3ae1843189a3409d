"""Language-model scores by context-tree weighting, next to a unigram word score.

Bytes are predicted bit by bit: each context of 0 to ``depth`` bytes has a binary tree of 255 nodes, one per bit prefix
of the next byte. A node's Krichevsky-Trofimov estimate from the training counts is mixed with its longer contexts'
product, half and half, over all depths; the weights are what the training texts made of them, and scoring leaves them
as they are. A text's score is the log10 probability of its bytes and an end byte. The unigram score takes lower-cased
words and an end token, add-one smoothed over the training vocabulary.

Documents are dealt by hash into blocks of at most 64 MB. A first pass counts each block's distinct symbols: words, and
runs of ``depth`` + 1 bytes. Their sums over all blocks are the corpus statistics: a table as large as the data needs,
never collected. The tree is worked out from it in groups by the last two context bytes, which hold all longer
contexts; only the two shortest depths, at most 65,536 nodes each, pass through the driver. Each block then gets the
values of its own symbols back and its texts are scored whole.

Cases: a null or empty text is one end token and one end byte; without training documents all bits are even and the
word score is 0 each; repeated rows are scored, and learned from, as often as they occur. Only id and text are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.llm import words as W
from duskwatch.llm.words import blocks_of
from duskwatch.session import stage

WORD_BIT = np.uint64(1 << 63)  # set in codes of words, never in those of byte runs
END = WORD_BIT
LEAST_BLOCK, MOST_BLOCK, BLOCKS = 1 << 20, 64 << 20, 24


class Symbols:
    """Codes of the words (and end tokens) and byte runs (and end bytes) of some texts, each with its text's number."""

    def __init__(self, texts: pa.Array, depth: int):
        n = len(texts)
        ws = W.of_texts(texts, W.NOT_SPACE)
        self.words = np.concatenate([(ws.hashes() >> np.uint64(1)) | WORD_BIT, np.full(n, END)])
        self.word_text = np.concatenate([np.repeat(np.arange(n), np.diff(ws.ptr)), np.arange(n)])
        data, offsets = W.raw_bytes(texts)
        lengths = np.diff(offsets)
        self.run_text = np.repeat(np.arange(n), lengths + 1)
        padded = np.zeros(len(data) + n * (depth + 1), np.uint64)
        padded[np.arange(len(data)) + np.repeat(np.arange(n) * (depth + 1) + depth, lengths)] = data
        at = np.arange(len(self.run_text)) + (self.run_text + 1) * depth
        self.runs = padded[at]
        for d in range(1, depth + 1):
            self.runs |= padded[at - d] << np.uint64(8 * d)


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[first], np.add.reduceat(counts, first)


def count_symbols(depth: int):
    """Per block the distinct codes with their counts in training documents (0: only in others)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = defaultdict(list)
        for batch in W.pieces(batches, "text"):
            blocks, train = batch.column("block").to_numpy(), batch.column("train").to_numpy(zero_copy_only=False)
            for block in np.unique(blocks):
                for taught in (True, False):
                    texts = batch.column("text").filter(pa.array((blocks == block) & (train == taught)))
                    if not len(texts):
                        continue
                    symbols = Symbols(texts, depth)
                    for codes in (symbols.words, symbols.runs):
                        found, n = np.unique(codes, return_counts=True)
                        held[block].append((found, n.astype(np.int64) if taught else np.zeros(len(n), np.int64)))
                if len(held[block]) > 24:
                    held[block] = [summed(held[block])]
        for block, parts in held.items():
            codes, counts = summed(parts)
            for at in range(0, len(codes), 1 << 16):
                part = codes[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block, np.int32)), pa.array(part.view(np.int64)), pa.array(counts[at : at + (1 << 16)])], ["block", "code", "n"])

    return run


def log_gamma(x: np.ndarray) -> np.ndarray:
    low = np.ones_like(x)
    for i in range(8):
        low = low * (x + i)
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - np.log(low)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability of a sequence with these counts by the Krichevsky-Trofimov estimate."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def mixed(own: np.ndarray, longer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A node's log probability, half its own estimate and half its longer contexts', and the share of its own in it."""
    total = np.logaddexp(own, longer) - np.log(2)
    return total, np.exp(own - np.log(2) - total)


class Bits:
    """The bits of byte runs: for each run and bit the node of its longest context, and the nodes of shorter ones."""

    def __init__(self, runs: np.ndarray, counts: np.ndarray):
        byte = (runs & np.uint64(255)).astype(np.int64)[:, None]
        j = np.arange(8)
        self.prefix = ((1 << j) | (byte >> (8 - j))).ravel()
        self.bit = ((byte >> (7 - j)) & 1).ravel()
        self.context = np.repeat((runs >> np.uint64(8)).astype(np.int64), 8)
        self.n = np.repeat(counts.astype(float), 8)

    def node(self, depth: int) -> np.ndarray:
        return ((self.context & ((1 << (8 * depth)) - 1)) << 8) | self.prefix


class Level(NamedTuple):
    keys: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    log_p: np.ndarray
    own_share: np.ndarray
    place: np.ndarray

    def estimate(self, bit: np.ndarray) -> np.ndarray:
        count = np.where(bit == 1, self.ones[self.place], self.zeros[self.place])
        return (count + 0.5) / (self.zeros[self.place] + self.ones[self.place] + 1)


def levels(bits: Bits, depth: int, least: int) -> dict[int, Level]:
    """The nodes of depths ``depth`` down to ``least`` from all runs that share them."""
    out: dict[int, Level] = {}
    for d in range(depth, least - 1, -1):
        keys, place = np.unique(bits.node(d), return_inverse=True)
        ones = np.bincount(place, bits.n * bits.bit, len(keys))
        zeros = np.bincount(place, bits.n * (1 - bits.bit), len(keys))
        own = log_kt(zeros, ones)
        if d == depth:
            out[d] = Level(keys, zeros, ones, own, np.ones(len(keys)), place)
            continue
        below = out[d + 1]
        parent = (((below.keys >> 8) & ((1 << (8 * d)) - 1)) << 8) | (below.keys & 255)
        total, share = mixed(own, np.bincount(np.searchsorted(keys, parent), below.log_p, len(keys)))
        out[d] = Level(keys, zeros, ones, total, share, place)
    return out


def groups(batches: Iterator[pa.RecordBatch], most: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(runs, counts) of whole groups, some groups at a time."""
    held, size = [], 0
    for rows in blocks_of(batches):
        held.append(rows)
        size += rows.num_rows
        if size >= most:
            yield of_rows(held)
            held, size = [], 0
    if held:
        yield of_rows(held)


def of_rows(tables: list[pa.Table]) -> tuple[np.ndarray, np.ndarray]:
    rows = pa.concat_tables(tables)
    return rows.column("code").to_numpy().view(np.uint64), rows.column("n").to_numpy()


def short_rows(depth: int):
    """Sums of the depth-2 nodes by the depth-1 node they belong to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs, counts in groups(batches):
            two = levels(Bits(runs, counts), depth, 2)[2]
            parent = two.keys & 0xFFFF
            keys, place = np.unique(parent, return_inverse=True)
            sums = [np.bincount(place, v, len(keys)) for v in (two.log_p, two.zeros, two.ones)]
            yield pa.RecordBatch.from_arrays([pa.array(keys), *map(pa.array, sums)], ["node", "log_p", "zeros", "ones"])

    return run


def value_rows(depth: int, shares: list[np.ndarray], estimates: list[np.ndarray]):
    """Each byte run's log10 probability, given its context; shares and estimates are those of depths 0 and 1 by node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs, counts in groups(batches):
            bits = Bits(runs, counts)
            found = levels(bits, depth, 2)
            p = found[depth].estimate(bits.bit)
            for d in range(depth - 1, 1, -1):
                share = found[d].own_share[found[d].place]
                p = share * found[d].estimate(bits.bit) + (1 - share) * p
            for d in (1, 0):
                node = bits.node(d)
                one = estimates[d][node]
                p = shares[d][node] * np.where(bits.bit == 1, one, 1 - one) + (1 - shares[d][node]) * p
            yield pa.RecordBatch.from_arrays([pa.array(runs.view(np.int64)), pa.array(np.log10(p).reshape(-1, 8).sum(axis=1))], ["code", "value"])

    return run


class Lookup:
    """Places of codes in a list that holds them all: a hash table, and a search where two codes share a slot."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = np.argsort(codes)
        self.mask = np.uint64((1 << max(4, int(4 * len(codes)).bit_length())) - 1)
        self.table = np.zeros(int(self.mask) + 1, np.int32)
        self.table[(W.mix(codes) & self.mask).astype(np.int64)] = np.arange(len(codes), dtype=np.int32)

    def places(self, asked: np.ndarray) -> np.ndarray:
        at = self.table[(W.mix(asked) & self.mask).astype(np.int64)]
        other = np.flatnonzero(self.codes[at] != asked)
        at[other] = self.order[np.searchsorted(self.codes, asked[other], sorter=self.order)]
        return at


def score_block(depth: int, unseen: float):
    def run(docs: pa.Table, symbols: pa.Table) -> pa.Table:
        lookup = Lookup(symbols.column("code").to_numpy().view(np.uint64))
        values = symbols.column("value").to_numpy()
        out = []
        for batch in W.pieces(docs.combine_chunks().to_batches(), "text"):
            n, s = batch.num_rows, Symbols(batch.column("text"), depth)
            of_words = values[lookup.places(s.words)]
            counts = [np.bincount(s.word_text, w, n) for w in (None, of_words > unseen, of_words)]
            score = np.bincount(s.run_text, values[lookup.places(s.runs)], n)
            columns = [*[pa.array(c.astype(np.int64)) for c in counts[:2]], pa.array(counts[2]), pa.array(score), pa.array(np.bincount(s.run_text, minlength=n) - 1)]
            out.append(pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("train"), *columns], ["doc_id", "train", "n_tokens", "n_known", "base_score", "score", "n_bytes"]))
        return pa.Table.from_batches(out)

    return run


def score_texts(docs: DataFrame, train: Column, *, doc_id: str = "doc_id", text: str = "text", depth: int = 4) -> DataFrame:
    """Per document: doc_id, train, n_tokens, n_known, train_tokens, base_score, score, n_bytes and bits_per_byte.

    ``train`` tells, of a row of ``docs``, whether the models learn from it; ``depth`` is 2 to 6.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    blocks = -(-size // min(max(size // BLOCKS, LEAST_BLOCK), MOST_BLOCK)) or 1
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"), F.coalesce(train, F.lit(False)).alias("train"), F.xxhash64(F.col(f"`{doc_id}`"), F.col(f"`{text}`")).alias("deal"))
    dealt = rows.withColumn("block", F.pmod(F.hash("deal"), F.lit(blocks)).cast("int"))  # as repartition() deals by that hash, a block is a partition
    found = stage(dealt.repartition(blocks, "deal").select("block", "train", "text").mapInArrow(count_symbols(depth), "block int, code bigint, n bigint"), "block-symbols")
    corpus = stage(found.groupBy("code").agg(F.sum("n").alias("n")), "corpus-symbols")
    vocabulary, tokens = corpus.where("code < 0").agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    tokens = tokens or 0
    below = float(tokens + vocabulary + 1)

    by_context = corpus.where("code >= 0").withColumn("block", F.shiftright("code", 8).bitwiseAND(F.lit(0xFFFF))).repartition("block").sortWithinPartitions("block")
    one = by_context.mapInArrow(short_rows(depth), "node bigint, log_p double, zeros double, ones double").groupBy("node").agg(*[F.sum(c).alias(c) for c in ("log_p", "zeros", "ones")])
    table = np.zeros((3, 1 << 16))
    for r in one.collect():  # at most 65,536 rows
        table[:, r["node"]] = r["log_p"], r["zeros"], r["ones"]
    log_p, share_1 = mixed(log_kt(table[1], table[2]), table[0])
    top = np.stack([log_p, table[1], table[2]]).reshape(3, 256, 256).sum(axis=1)
    _, share_0 = mixed(log_kt(top[1], top[2]), top[0])
    estimates = [(ones + 0.5) / (zeros + ones + 1) for zeros, ones in ((top[1], top[2]), (table[1], table[2]))]
    runs = by_context.mapInArrow(value_rows(depth, [share_0, share_1], estimates), "code bigint, value double")
    of_words = corpus.where("code < 0").select("code", F.log10((F.col("n") + 1) / F.lit(below)).alias("value"))
    values = stage(runs.unionByName(of_words), "symbol-values")

    unseen = float(np.log10(1 / below)) + 1e-9
    id_type = rows.schema["doc_id"].dataType.simpleString()
    scored = dealt.select("block", "doc_id", "train", "text").groupBy("block").cogroup(found.select("block", "code").join(values, "code").groupBy("block")).applyInArrow(
        score_block(depth, unseen), f"doc_id {id_type}, train boolean, n_tokens bigint, n_known bigint, base_score double, score double, n_bytes bigint"
    )
    bits = F.when(F.col("n_bytes") > 0, -F.col("score") * F.lit(float(np.log2(10))) / F.col("n_bytes"))
    return scored.withColumn("train_tokens", F.lit(tokens).cast("long")).withColumn("bits_per_byte", bits)
