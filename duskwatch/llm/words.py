"""Words of text columns as numpy arrays: positions and 64-bit hashes, a few megabytes of text at a time."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 19  # bytes of text handled at once, a bound on the arrays made of it; a longer text is handled alone
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
MULTIPLIERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)  # of the splitmix64 finalizer

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MULTIPLIERS[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MULTIPLIERS[1])
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse modulo 2**64, made longer as needed."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * PIECE)
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            cls.up = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, BASE))), dtype=np.uint64)
            cls.down = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, inverse))), dtype=np.uint64)
        return cls.up, cls.down


class Words(NamedTuple):
    """Lower-cased bytes of some texts, each word's start and end in them, and each text's range of words."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    ptr: np.ndarray

    def hashes(self) -> np.ndarray:
        up, down = Powers.upto(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)], out=sums[1:])
        length = (self.ends - self.starts).astype(np.uint64)
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts] + length * np.uint64(MULTIPLIERS[0]))

    def text(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].tobytes().decode()

    def joined(self, i: int, n: int) -> str:
        return " ".join(self.text(j) for j in range(i, i + n))


def of_texts(texts: pa.Array, member: np.ndarray, lower: bool = True) -> Words:
    data, offsets = raw_bytes(texts)
    if lower:
        data = LOWER[data]
    inside = member[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of some texts (null: empty) in a row, and where each begins."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``PIECE`` bytes of text."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = int(sizes[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(sizes, done + PIECE, "right")))
            yield batch.slice(at, end - at)
            at = end


def grams(hashes: np.ndarray, ptr: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of k words in a row, the word each starts at, and each text's range of them."""
    count = np.maximum(np.diff(ptr) - k + 1, 0)
    out = np.concatenate(([0], np.cumsum(count)))
    at = np.repeat(ptr[:-1] - out[:-1], count) + np.arange(out[-1])
    total = np.zeros(len(at), np.uint64)
    for i in range(k):
        total = (total + hashes[at + i]) * BASE
    return mix(total), at, out


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of a sorted partition, one table for each value of ``block``."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        names = now.column("block").to_numpy()
        cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(names)]
        for at, end in zip(cuts, cuts[1:]):
            if held and held[0].column("block")[0] != now.column("block")[at]:
                yield pa.concat_tables(held)
                held = []
            held.append(now.slice(at, end - at))
    if held:
        yield pa.concat_tables(held)


class BitTable:
    """A set of 64-bit keys in a bit table of fixed size, with two bits a key: all keys of the set and a few others."""

    BITS = 1 << 26  # 8 MB however many keys there are

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @classmethod
    def of(cls, keys: DataFrame) -> BitTable:
        """From the column ``key``. The driver gets BITS / 64 numbers at most."""
        low, high = F.col("key").bitwiseAND(F.lit(cls.BITS - 1)), F.shiftrightunsigned("key", 32).bitwiseAND(F.lit(cls.BITS - 1))
        bit = keys.select(F.explode(F.array(low, high)).alias("bit"))
        words = bit.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("word")).toArrow()
        bits = np.zeros(cls.BITS // 64, np.uint64)
        bits[words.column("at").to_numpy()] = words.column("word").to_numpy().view(np.uint64)
        return cls(bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for bit in (keys & np.uint64(self.BITS - 1), (keys >> np.uint64(32)) & np.uint64(self.BITS - 1)):
            found &= (self.bits[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
        return found
