"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Each source's share of the words wanted goes by its weight. A share above ``max_epochs`` times the source's size is
clamped there, and the excess goes to the others by weight, until none is above. A source is then repeated as often as
its target holds it whole; what is left is filled with one more copy of the source's documents in the order of a seeded
hash, as far as the rest reaches (to the nearest document). That prefix of the order is one threshold per source: the
documents are dealt over 4,096 hash ranges, the range where the rest ends comes from their sums, and only the documents
of that one range are put in order, equal rows as one with their number. Of the rows equal to the last one as many are
taken as fit.

Cases: a null text or id is fine (size 0; the hash of an empty id); a null source is a source of its own, last in
order; sources without words have target 0; a source of null or no weight gets nothing. Repeated rows count as
documents of their own. An empty table gives an empty mix. Other columns of the rows are kept, but clashing names
(size, source_size, target, copies, taken) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.session import stage

SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
SEED = 11
PART = 1 << 16  # equal rows written by one task
ADDED = ("size", "source_size", "target", "copies", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """Never null and sorted by code point, null last."""
    return F.coalesce(F.concat(F.lit("0"), source), F.lit("1"))


def id_hash(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def seeded_order(rows: DataFrame, seed: int) -> Column:
    """By hash of the id, size and, where rows of one id differ, by hash of the row: equal ones have equal rows."""
    mark = [F.lpad(F.hex("_mark"), 16, "0")] if "_mark" in rows.columns else []
    return F.concat(id_hash(seed), F.lpad(F.col("size").cast("string"), 19, "0"), *mark)


def with_ordinal(df: DataFrame, key: str) -> DataFrame:
    """Add ``ordinal``, from 0, by the order of a unique key, without sorting all rows in one task."""
    cut = stage(df.repartitionByRange(df.sparkSession.sparkContext.defaultParallelism, key).withColumn("_part", F.spark_partition_id()), "ordinals")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    starts = cut.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(key)) - 1
    return cut.withColumn("_own", own).join(starts, "_part").withColumn("ordinal", F.col("_start") + F.col("_own")).drop("_part", "_own", "_start")


def water_fill(sources: DataFrame, total: int, max_epochs: int) -> DataFrame:
    """Add ``target`` to (source_size, weight): rounds of sums over the sources until no share is above its cap."""
    sources = sources.withColumn("weight", F.coalesce("weight", F.lit(0)))
    cap = F.col("source_size") * max_epochs
    left, weights, clamped = total, sources.agg(F.sum("weight")).first()[0] or 0, -1
    while True:
        above = cap.cast("double") * float(weights) < F.col("weight").cast("double") * float(left)
        n, held, rest = sources.agg(F.count_if(above), F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))).first()
        if n == clamped or not weights:
            share = F.col("weight") * F.lit(float(left)) / F.lit(float(weights)) if weights else F.lit(0.0)
            return sources.withColumn("target", F.when(above, cap.cast("double")).otherwise(share).cast("double"))
        left, weights, clamped = total - (held or 0), rest or 0, n


def plan_mix(sizes: DataFrame, weigh, *, share: float = 1.0, max_epochs: int = 3, seed: int = SEED) -> DataFrame:
    """Per source (_source, source_size, target, whole, last, more): repetitions, the last document, in seeded order, of one
    more, and how many of the rows equal to it take part.

    ``sizes`` has doc_id, _source and size; ``weigh`` adds weight to (_source, source_size).
    """
    by_range = sizes.select("_source", "size", F.substring(seeded_order(sizes, seed), 1, 3).alias("range"))
    sums = stage(by_range.groupBy("_source", "range").agg(F.sum("size").alias("size")), "mix-sums")
    sources = stage(weigh(sums.groupBy("_source").agg(F.sum("size").alias("source_size"))), "mix-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    filled = (
        water_fill(sources, int(total * share) if share != 1.0 else total, max_epochs)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .drop("weight")
    )
    before = Window.partitionBy("_source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_source", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    ends = stage(
        starts.join(filled, "_source").where("start <= rest").groupBy("_source").agg(
            F.max(F.struct("range", "start")).alias("end"), *[F.first(c).alias(c) for c in ("source_size", "target", "whole", "rest")]
        ),
        "mix-ends",
    )
    inside = (
        sizes.withColumn("_order", seeded_order(sizes, seed)).withColumn("range", F.substring("_order", 1, 3))
        .join(ends.select("_source", F.col("end.range").alias("range"), F.col("end.start").alias("start"), "rest"), ["_source", "range"])
        .groupBy("_source", "range", "_order", "size", "start", "rest").agg(F.count("*").alias("n"))  # equal rows are one
    )
    before = Window.partitionBy("_source", "range").orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    past = F.col("start") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(before), F.lit(0))

    def fits(m: Column) -> Column:
        """The middle of the m-th of equal rows lies before the rest's end."""
        return 2 * (F.col("past") + (m - 1) * F.col("size")) + F.col("size") <= 2 * F.col("rest")

    about = F.when(F.col("size") > 0, F.floor((F.col("rest") - F.col("past")) / F.col("size") + 0.5)).otherwise(F.col("n")).cast("long")
    near = F.when(fits(F.col("about") + 1), F.col("about") + 1).when(fits(F.col("about")), F.col("about")).otherwise(F.col("about") - 1)
    counted = inside.withColumn("past", past).withColumn("about", about).withColumn("more", F.greatest(F.lit(0), F.least("n", near)))
    taken = counted.where("more > 0 AND rest > 0").groupBy("_source").agg(F.max(F.struct("_order", "more")).alias("last"))
    order, more = F.when(F.col("rest") > 0, F.coalesce("last._order", "end.range")).otherwise(""), F.coalesce("last.more", F.lit(0).cast("long"))
    return stage(ends.join(taken, "_source", "left").select("_source", "source_size", "target", "whole", order.alias("last"), more.alias("more")), "mix-plan")


def sized(docs: DataFrame, doc_id: str, text: str, source: str, *keep: Column) -> DataFrame:
    return docs.select(*keep, F.col(f"`{doc_id}`").alias("doc_id"), source_key(F.col(f"`{source}`")).alias("_source"), word_count(F.col(f"`{text}`")).alias("size"))


def mix_ids(docs: DataFrame, weigh, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """Each row's doc_id with size, source_size, target (its source's), copies (0 to ``max_epochs``) and taken words; texts are read once."""
    sizes = stage(sized(docs, doc_id, text, source), "mix-sizes")
    return with_copies(sizes, plan_mix(sizes, weigh, **options), options.get("seed", SEED))


def mix_sources(docs: DataFrame, weigh, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: every row as often as it is taken, with size, source_size, target, copies and taken."""
    keep = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ADDED]
    mark = F.xxhash64(*[F.to_json(F.struct(c.alias("c"))) for c in keep])
    plan = plan_mix(stage(sized(docs, doc_id, text, source, mark.alias("_mark")), "mix-sizes"), weigh, **options)
    rows = sized(docs, doc_id, text, source, F.struct(*keep).alias("_row"), mark.alias("_mark"))
    mixed = with_copies(rows, plan, options.get("seed", SEED)).where("copies > 0")
    return mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select("_row.*", "size", "source_size", "target", "copies", "taken")


def with_copies(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Apply a plan to rows that have doc_id, _source and size.

    The rows equal to a source's last one are counted and written out again by number, ``PART`` a task.
    """
    planned = rows.withColumn("_order", seeded_order(rows, seed)).join(plan, "_source", "left")
    last = F.col("_order") == F.col("last")
    kept = [c for c in planned.columns if c not in ("_source", "_order")]
    plain = planned.where(~F.coalesce(last, F.lit(False))).select(*kept, F.coalesce(F.col("_order") < F.col("last"), F.lit(False)).alias("_one"))
    edge = plan.select("_source", F.substring("last", 1, 32).alias("_id"))  # few rows have these ids, so sizes are not made of all
    some = rows.withColumn("_id", id_hash(seed)).join(edge, ["_source", "_id"], "left_semi").drop("_id")
    some = some.withColumn("_order", seeded_order(some, seed)).join(plan, "_source")
    equal = some.where(last).groupBy("_source", "_order").agg(*[F.any_value(c).alias(c) for c in kept], F.count("*").alias("_n"))
    parts = equal.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / PART)))).repartition("_source", "_part")
    number = F.explode(F.sequence(F.col("_part") * PART + 1, F.least(F.col("_n"), (F.col("_part") + 1) * PART)))
    numbered = parts.withColumn("_number", number).select(*kept, (F.col("_number") <= F.col("more")).alias("_one"))
    return (
        plain.unionByName(numbered)
        .withColumn("copies", F.col("whole") + F.col("_one").cast("int"))
        .withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))
        .drop("whole", "last", "more", "_one", "_mark")
    )


def cycle_weights(weights: tuple[int, ...]):
    """Weigh sources by their order, repeating the weights given."""

    def weigh(sources: DataFrame) -> DataFrame:
        at = F.pmod(F.col("ordinal"), F.lit(len(weights))).cast("int")
        return with_ordinal(sources, "_source").withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), at + 1)).drop("ordinal")

    return weigh
