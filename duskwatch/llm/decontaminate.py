"""Benchmark decontamination by winnowing.

Texts are words of letters and digits, ASCII lower-cased. Of each window of ``window`` words the smallest hash of its
``k``-word runs is kept as fingerprint, on both sides by the same rule, so every shared window shares a fingerprint. A
bit table of fixed size holds the benchmark's fingerprints; document fingerprints in it are extended to all windows
around them, and those are joined with the benchmark's windows as whole texts: what is found is exact. Items shorter than
a window are one window of their own length, looked up at every position.

Windows with the same set of items are one class, and documents with the same classes share one list of items, so a
passage in many documents and items is not multiplied out.

Cases: null or empty texts have no words and no hits; items without id or words are ignored, repeated items count once,
repeated documents get a row each. Only the id and text columns are read; other columns never matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.llm import words as W
from duskwatch.session import stage

BITS = 1 << 23  # of the fingerprint table: 1 MB however many items there are


def winnow(hashes: np.ndarray, ptr: np.ndarray, width: int) -> np.ndarray:
    """Positions that hold the last smallest hash of some ``width`` neighbours within a text."""
    count = np.maximum(np.diff(ptr) - width + 1, 0)
    out = np.concatenate(([0], np.cumsum(count)))
    first = np.repeat(ptr[:-1] - out[:-1], count) + np.arange(out[-1])
    best, at = hashes[first].copy(), first.copy()
    for i in range(1, width):
        other = hashes[first + i]
        better = other <= best
        best[better] = other[better]
        at[better] = first[better] + i
    return np.unique(at)


def fingerprints(ws: W.Words, hashes: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed hashes of runs of k words, and the word each starts at."""
    runs, at, ptr = W.grams(hashes, ws.ptr, k)
    chosen = winnow(runs, ptr, window - k + 1)
    return runs[chosen], at[chosen]


def item_rows(window: int, k: int):
    """Per item: its windows, and the hashes by which documents find them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, "text"):
            ws = W.of_texts(batch.column("text"), W.ALNUM)
            hashes = ws.hashes()
            prints, at = fingerprints(ws, hashes, window, k)
            owner = np.searchsorted(ws.ptr, at, "right") - 1
            windows, lengths, keys = [], [], []
            for d in range(batch.num_rows):
                first, n = int(ws.ptr[d]), int(ws.ptr[d + 1] - ws.ptr[d])
                length = min(n, window)
                lengths.append(length)
                windows.append(sorted({ws.joined(i, length) for i in range(first, first + n - length + 1)}) if n else [])
                if 0 < n < window:
                    keys.append(W.grams(hashes, np.array([first, first + n]), n)[0].view(np.int64).tolist())
                else:
                    keys.append(prints[owner == d].view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), pa.array(lengths, pa.int32()), pa.array(windows, pa.list_(pa.string())), pa.array(keys, pa.list_(pa.int64()))],
                ["item_id", "length", "windows", "keys"],
            )

    return run


def doc_rows(table: np.ndarray, window: int, k: int, short: list[int]):
    """Per document: its number of words and every window that may be an item's."""

    def listed(keys: np.ndarray) -> np.ndarray:
        bit = keys & np.uint64(BITS - 1)
        return (table[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, "text"):
            ws = W.of_texts(batch.column("text"), W.ALNUM)
            hashes = ws.hashes()
            prints, at = fingerprints(ws, hashes, window, k)
            at = at[listed(prints)]
            owner = np.searchsorted(ws.ptr, at, "right") - 1
            around = at[:, None] - np.arange(window - k + 1)
            fits = (around >= ws.ptr[owner][:, None]) & (around + window <= ws.ptr[owner + 1][:, None])
            found = [(window, np.unique(around[fits]))]
            for n in short:
                runs, first, _ = W.grams(hashes, ws.ptr, n)
                found.append((n, first[listed(runs)]))
            start = np.concatenate([f for _, f in found]).astype(np.int64)
            length = np.concatenate([np.full(len(f), n, np.int32) for n, f in found])
            order = np.lexsort((length, start))
            start, length = start[order], length[order]
            owner = np.searchsorted(ws.ptr, start, "right") - 1
            texts = [ws.joined(int(s), int(n)) for s, n in zip(start, length)]
            spans = pa.StructArray.from_arrays([pa.array((start - ws.ptr[owner]).astype(np.int32)), pa.array(length), pa.array(texts, pa.string())], ["at", "length", "window"])
            offsets = pa.array(np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("text_hash"), pa.array(np.diff(ws.ptr).astype(np.int64)), pa.ListArray.from_arrays(offsets, spans)],
                ["row", "doc_id", "text_hash", "n_words", "spans"],
            )

    return run


def contamination(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", window: int = 10, k: int = 5) -> DataFrame:
    """Per document: doc_id, text_hash (xxhash64), n_words, n_hit (words in windows of items), items (ids as sorted strings) and contaminated."""
    spark = docs.sparkSession
    asked = items.select(F.col(f"`{item_id}`").cast("string").alias("item_id"), F.col(f"`{text}`").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    known = stage(asked.mapInArrow(item_rows(window, k), "item_id string, length int, windows array<string>, keys array<bigint>"), "items")
    keys = known.select(F.explode("keys").alias("key")).select(F.col("key").bitwiseAND(F.lit(BITS - 1)).alias("bit"))
    words = keys.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits")).collect()  # at most BITS / 64 rows
    table = np.zeros(BITS // 64, np.uint64)
    for row in words:
        table[row["at"]] = np.uint64(row["bits"] & 0xFFFFFFFFFFFFFFFF)
    short = sorted(r[0] for r in known.where(f"length BETWEEN 1 AND {window - 1}").select("length").distinct().collect())

    by_window = known.select("item_id", F.explode("windows").alias("window")).distinct()
    sets = by_window.groupBy("window").agg(F.count("*").alias("n"), F.sum(F.xxhash64("item_id").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64(F.lit(7), "item_id")).alias("x"))
    classes = stage(sets.select("window", F.md5(F.concat_ws(":", "n", "s", "x")).alias("class")), "item-windows")
    one_each = classes.groupBy("class").agg(F.min("window").alias("window"))
    members = by_window.join(one_each, "window").select("class", "item_id")

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash"), F.col(f"`{text}`").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    read = stage(
        rows.mapInArrow(doc_rows(table, window, k, short), f"row bigint, doc_id {id_type}, text_hash bigint, n_words bigint, spans array<struct<at: int, length: int, window: string>>"),
        "doc-windows",
    )
    hits = read.where(F.size("spans") > 0).select("row", F.inline("spans")).join(classes, "window")
    past = Window.partitionBy("row").orderBy("at", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("at") + F.col("length")
    new = F.greatest(F.lit(0), end - F.greatest(F.col("at"), F.coalesce(F.max(end).over(past), F.lit(0))))
    per_doc = stage(
        hits.select("row", "class", new.alias("new")).groupBy("row").agg(F.sum("new").cast("long").alias("n_hit"), F.array_sort(F.collect_set("class")).alias("classes"))
        .withColumn("combo", F.md5(F.array_join("classes", ","))),
        "doc-hits",
    )
    combos = per_doc.groupBy("combo").agg(F.first("classes").alias("classes"))
    listed = combos.select("combo", F.explode("classes").alias("class")).join(members, "class").groupBy("combo").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    listed = stage(listed, "item-lists")
    found = stage(per_doc.select("row", "n_hit", "combo").join(listed, "combo").select("row", "n_hit", "items"), "doc-items")
    out = read.select("row", "doc_id", "text_hash", "n_words").join(found, "row", "left")
    return out.select(
        "doc_id", "text_hash", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that share no window with an item, with all their columns."""
    bad = contamination(docs, items, doc_id=doc_id, text=text, **options).where("contaminated").select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct()
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col("_bad_id")) & (F.xxhash64(F.col(f"`{text}`")) == F.col("_bad_hash"))
    return docs.join(stage(bad, "contaminated"), same, "left_anti")
