"""Near-duplicate groups by MinHash bands and sequential Bayesian verification.

A document's set is its distinct runs of ``size`` words (a shorter document is one run), as 64-bit hashes. Documents with
equal sets are one class from the start. Classes that agree in a band of their signatures are candidates. Their
signatures are compared a batch at a time, and a pair is dropped once the posterior probability (uniform prior) that its
similarity reaches the threshold is below ``miss``; the rest is verified on the full sets.

Pairs within a group are never listed. First every member meets its bucket's smallest id; verified pairs make
components, and pairs that only the signatures let through make canopies, which hold a group of copies and its more
distant relatives. Then, inside a canopy, documents of different components are compared, signatures first and full sets
after, within blocks of some hundreds that carry the texts: only new links leave a block. Last, members of a bucket that
are in different canopies are compared by signatures, cut by set size (a similarity bounds the ratio of sizes) and in
blocks too, and the few pairs left are verified. With bands of 5 out of 125 hashes a pair at 0.85 is missed as a
candidate with probability 4e-7, and one at ``miss`` by the signatures.

Cases: a null or empty text has the empty set and no links; a row without id has none either and is kept. A document is
an id with a text: rows with both the same are one, rows with one id and different texts are as many, each in the
component of its own text. Only id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.llm import words as W
from duskwatch.session import stage

BANDS, ROWS = 25, 5
HASHES = BANDS * ROWS
BLOCK = 256  # documents on a side of a block
BLOCK_SHINGLES = 1 << 19  # shingles on a side of a block
PAIR = "a bigint, b bigint"
_RNG = np.random.default_rng(20240229)
FACTORS = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
MASKS = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct hashes."""
    ws = W.of_texts(texts, W.NOT_SPACE)
    hashes = ws.hashes()
    runs, _, ptr = W.grams(hashes, ws.ptr, size)
    for d in range(len(texts)):
        n = int(ws.ptr[d + 1] - ws.ptr[d])
        if 0 < n < size:
            yield W.grams(hashes, ws.ptr[d : d + 2], n)[0]
        else:
            yield np.unique(runs[ptr[d] : ptr[d + 1]])


def signature(shingles: np.ndarray) -> np.ndarray:
    best = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 2048):
        part = (short[at : at + 2048][None, :] ^ MASKS[:, None]) * FACTORS[:, None]
        np.minimum(best, part.min(axis=1), out=best)
    return best


def band_keys(sign: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for part in sign.astype(np.uint64).reshape(BANDS, ROWS).T:
        keys = W.mix((keys + part) * W.BASE)
    return keys.view(np.int64)


def sign_docs(size: int):
    """Each text's number of shingles, digest of its set, band keys, and the last byte of each of its MinHashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, "text"):
            counts, digests, bands, signs = [], [], [], []
            for found in shingle_sets(batch.column("text"), size):
                sign = signature(found) if len(found) else None
                counts.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).hexdigest() if len(found) else None)
                bands.append(None if sign is None else band_keys(sign))
                signs.append(None if sign is None else sign.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("row", "doc_id", "text_hash")], pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(bands, pa.list_(pa.int64())), pa.array(signs, pa.binary())],
                ["row", "doc_id", "text_hash", "n_shingles", "digest", "bands", "sign"],
            )

    return run


def signs_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES)


def least_matches(threshold: float, miss: float) -> list[tuple[int, int]]:
    """After n compared hashes, the fewest matches whose posterior P(similarity >= threshold) is at least ``miss``."""
    out = []
    for n in range(ROWS, HASHES + 1, ROWS):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def prune(a: np.ndarray, b: np.ndarray, limits: list[tuple[int, int]]) -> np.ndarray:
    """Indices of the pairs that no batch of hashes rules out."""
    alive, matches, done = np.arange(len(a)), np.zeros(len(a), np.int32), 0
    for n, least in limits:
        matches = matches + (a[alive, done:n] == b[alive, done:n]).sum(axis=1)
        keep = matches >= least
        alive, matches, done = alive[keep], matches[keep], n
        if not len(alive):
            break
    return alive


def pair_rows(limits: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                alive = pa.array(prune(signs_of(batch.column("sign_a")), signs_of(batch.column("sign_b")), limits))
                yield batch.select(["a", "b"]).take(alive)

    return run


def near_sizes(n: np.ndarray, i: int, other: np.ndarray, threshold: float) -> np.ndarray:
    return np.minimum(n[other], n[i]) >= threshold * np.maximum(n[other], n[i])


def block_rows(limits: list[tuple[int, int]], threshold: float):
    """Survivors of blocks, left against right: in different components and canopies, sizes near enough, signatures alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in W.blocks_of(batches):
            left, n, canopy, comp, own, ids = (rows.column(c).to_numpy() for c in ("left", "n", "canopy", "component", "own", "id"))
            signs = signs_of(rows.column("sign").combine_chunks())
            right = np.flatnonzero(~left)
            for i in np.flatnonzero(left):
                other = right[(canopy[right] != canopy[i]) & (comp[right] != comp[i]) & (own[right] | own[i]) & near_sizes(n, i, right, threshold)]
                if len(other):
                    close = ids[other[prune(np.broadcast_to(signs[i], (len(other), HASHES)), signs[other], limits)]]
                    if len(close):
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(close, ids[i])), pa.array(np.maximum(close, ids[i]))], ["a", "b"])

    return run


def linked_rows(limits: list[tuple[int, int]], threshold: float, size: int, percent: int):
    """New links of blocks whose rows carry texts: full sets are compared where signatures are alike, until both are in one component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in W.blocks_of(batches):
            left, n, ids = (rows.column(c).to_numpy() for c in ("left", "n", "id"))
            comp = rows.column("component").to_numpy().copy()
            signs = signs_of(rows.column("sign").combine_chunks())
            sets = list(shingle_sets(rows.column("text").combine_chunks(), size))
            right = np.flatnonzero(~left)
            out_a, out_b = [], []
            for i in np.flatnonzero(left):
                other = right[(comp[right] != comp[i]) & near_sizes(n, i, right, threshold)]
                if not len(other):
                    continue
                close = other[prune(np.broadcast_to(signs[i], (len(other), HASHES)), signs[other], limits)]
                if not len(close) or not len(sets[i]):
                    continue
                found = np.concatenate([sets[j] for j in close])
                sizes = np.array([len(sets[j]) for j in close])
                at = np.minimum(np.searchsorted(sets[i], found), len(sets[i]) - 1)
                both = np.add.reduceat((sets[i][at] == found).astype(np.int64), np.cumsum(sizes) - sizes)
                for j in close[100 * both >= percent * (len(sets[i]) + sizes - both)]:
                    if comp[j] != comp[i]:
                        comp[comp == comp[j]] = comp[i]
                        out_a.append(min(ids[i], ids[j]))
                        out_b.append(max(ids[i], ids[j]))
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    return run


def listed_rows(table):
    """The rows whose key may be in a bit table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.drop_columns(["key"]).filter(pa.array(table.value.has(keys)))

    return run


def exact_rows(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, "text_a"):
            linked = []
            for x, y in zip(shingle_sets(batch.column("text_a"), size), shingle_sets(batch.column("text_b"), size)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(len(x) > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every end of an edge; root is its component's smallest id. Each round contracts ids into their smallest neighbour's."""
    roots, left = None, stage(edges.select("a", "b").distinct(), "edges")
    while True:
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("root"))
        parent = stage(near.join(near.select(F.col("id").alias("root"), F.col("root").alias("next")), "root").select("id", F.col("next").alias("root")), "parents")
        if roots is None:
            roots = parent
        else:
            up = parent.select(F.col("id").alias("root"), F.col("root").alias("next"))
            roots = stage(roots.join(up, "root", "left").select("id", F.coalesce("next", "root").alias("root")), "roots")
        of_a, of_b = parent.select(F.col("id").alias("a"), F.col("root").alias("ra")), parent.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        moved = left.join(of_a, "a").join(of_b, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b"))
        left = stage(moved.distinct(), "edges")
        if left.isEmpty():
            return roots


def meetings(rows: DataFrame, group: list[str], kind: str) -> DataFrame:
    """Deal the rows of each group that holds several kinds into blocks (block, left) so that all of different kinds meet.

    Those outside the group's largest kind are the left sides and all are right sides: a group of many alike and few
    others is sent about once.
    """
    of_kind = rows.groupBy(*group, kind).agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    sums = of_kind.groupBy(*group).agg(F.max(F.struct("c", "s", kind)).alias("main"), F.sum("c").alias("c"), F.sum("s").alias("s")).where("c > main.c")

    def fan(c: Column, s: Column) -> Column:
        return F.greatest(F.ceil(c / BLOCK), F.ceil(s / BLOCK_SHINGLES)).cast("int")

    fans = stage(sums.select(*group, F.col(f"main.{kind}").alias("main"), fan(F.col("c"), F.col("s")).alias("all"), fan(F.col("c") - F.col("main.c"), F.col("s") - F.col("main.s")).alias("outside")), "fans")
    met = rows.join(fans, group)
    every = [F.struct(F.lit(False).alias("left"), F.pmod(F.xxhash64("id"), "all").cast("int").alias("cell"), F.col("outside").alias("others"))]
    outsider = F.struct(F.lit(True).alias("left"), F.pmod(F.xxhash64(F.lit(1), "id"), "outside").cast("int").alias("cell"), F.col("all").alias("others"))
    sides = F.when(F.col(kind) != F.col("main"), F.array(*every, outsider)).otherwise(F.array(*every))
    sided = met.withColumn("side", F.explode(sides)).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("side.others") - 1)))
    i, j = F.when(F.col("side.left"), F.col("side.cell")).otherwise(F.col("other")), F.when(F.col("side.left"), F.col("other")).otherwise(F.col("side.cell"))
    return sided.select(F.xxhash64(*group, i, j).alias("block"), F.col("side.left").alias("left"), *rows.columns)


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80, miss: float = 1e-6) -> DataFrame:
    """Per document: doc_id, text_hash (xxhash64), n_shingles, component_id, component_hash and kept.

    The smallest (doc_id, text_hash) names the component, by both where ids repeat, and is kept.
    """
    spark, threshold = docs.sparkSession, percent / 100
    limits = least_matches(threshold, miss)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("text_hash"), F.col(f"`{text}`").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    named = f"doc_id {id_type}, text_hash bigint"
    signed = stage(rows.mapInArrow(sign_docs(size), f"row bigint, {named}, n_shingles bigint, digest string, bands array<bigint>, sign binary"), "signed")
    by_set = signed.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
    classes = by_set.agg(F.min(F.struct("doc_id", "text_hash")).alias("name"), *[F.first(c).alias(c) for c in ("n_shingles", "bands", "sign")])
    classes = stage(classes.select(F.monotonically_increasing_id().alias("id"), "digest", "name", F.col("n_shingles").alias("n"), "bands", "sign"), "classes")
    bands = classes.select("id", F.explode("bands").alias("key"))
    buckets = stage(bands.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("n")).where("n > 1"), "buckets")
    members = stage(bands.join(buckets, "key").select("key", "id", "hub", F.col("n").alias("members")), "members")
    pairs = members.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()

    def of(name: str) -> DataFrame:
        return classes.select(F.col("id").alias(name), F.col("sign").alias(f"sign_{name}"))

    def texts_of(ids: DataFrame) -> DataFrame:
        """(id, text) of the classes with these ids. Of the documents only those in a bit table of their keys are shuffled."""
        needed = stage(classes.select("id", "name.*").join(ids.select("id").distinct(), "id", "left_semi"), "needed")
        key = F.xxhash64("doc_id", "text_hash").alias("key")
        table = spark.sparkContext.broadcast(W.BitTable.of(needed.select(key)))
        listed = rows.select("doc_id", "text_hash", "text", key).mapInArrow(listed_rows(table), f"{named}, text string")
        picked = listed.join(needed, ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"])
        return stage(picked.select("id", "text"), "texts")

    def verified(survivors: DataFrame) -> DataFrame:
        """Pairs of (a, b) whose full sets are similar."""
        texts = texts_of(survivors.select(F.explode(F.array("a", "b")).alias("id")))
        both = survivors.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
        return both.mapInArrow(exact_rows(size, percent), PAIR).distinct()

    def blocks(dealt: DataFrame, compare) -> DataFrame:
        return dealt.repartition("block").sortWithinPartitions("block").mapInArrow(compare, PAIR)

    alike = stage(pairs.join(of("a"), "a").join(of("b"), "b").mapInArrow(pair_rows(limits), PAIR), "survivors")
    edges = stage(verified(alike), "links")

    # inside canopies: documents that no verified link has joined yet
    canopies = components(alike).select("id", F.col("root").alias("canopy"))
    placed = canopies.join(components(edges), "id", "left").select("id", "canopy", F.coalesce("root", "id").alias("component"))
    sums = placed.groupBy("canopy").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("canopy")
    inside = stage(placed.join(sums, "canopy").join(classes.select("id", "n", "sign"), "id"), "inside")
    met = meetings(inside.join(texts_of(inside), "id"), ["canopy"], "component")
    edges = stage(edges.unionByName(blocks(met, linked_rows(limits, threshold, size, percent))), "links")

    # members of one bucket in different canopies: a size class meets itself and the one below
    placed = stage(canopies.join(components(edges), "id", "left").select("id", "canopy", F.coalesce("root", "id").alias("component")), "placed")
    of_bucket = members.where("members > 2").join(placed, "id", "left").select("key", "id", F.coalesce("canopy", "id").alias("canopy"), F.coalesce("component", "id").alias("component"))
    of_bucket = stage(of_bucket, "bucket-members")
    mixed = of_bucket.groupBy("key").agg(F.min("canopy").alias("x"), F.max("canopy").alias("y")).where("x <> y").select("key")
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.lit(-log(threshold))).cast("int")
    sized = of_bucket.join(mixed, "key").join(classes.select("id", "n", "sign"), "id").withColumn("class", size_class)
    sized = sized.withColumn("meet", F.explode(F.array(F.col("class"), F.col("class") + 1))).withColumn("own", F.col("meet") == F.col("class")).drop("class")
    late = stage(blocks(meetings(stage(sized, "sized"), ["key", "meet"], "canopy"), block_rows(limits, threshold)).distinct(), "late-survivors")
    roots = components(edges.unionByName(verified(late)))

    of_class = stage(classes.select("id", "digest", "name").join(roots, "id", "left").select("digest", "name", F.coalesce("root", "id").alias("root")), "class-roots")
    names = of_class.groupBy("root").agg(F.min("name").alias("component"))
    of_set = of_class.select("digest", "root").join(names, "root").select("digest", "component")
    placed_rows = signed.select("row", "doc_id", "text_hash", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest")).join(of_set, "digest", "left")
    own = (F.col("component.doc_id") == F.col("doc_id")) & (F.col("component.text_hash") == F.col("text_hash"))
    return placed_rows.select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("component.doc_id", "doc_id").alias("component_id"),
        F.coalesce("component.text_hash", "text_hash").alias("component_hash"), F.coalesce(own, F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each component, with all its columns; of rows with one id and text one; rows without id stay."""
    found = near_duplicates(docs, doc_id=doc_id, text=text, **options)
    kept = stage(found.where("kept AND doc_id IS NOT NULL").select("doc_id", "text_hash").distinct(), "kept")
    own, of_text = F.col(f"`{doc_id}`"), F.xxhash64(F.col(f"`{text}`"))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), own.alias("doc_id"), of_text.alias("text_hash"))
    once = Window.partitionBy("doc_id", "text_hash").orderBy("text_hash")
    some = whole.join(kept, ["doc_id", "text_hash"], "left_semi").withColumn("n", F.row_number().over(once)).where("n = 1")
    return some.select("row.*").unionByName(docs.where(own.isNull()))
