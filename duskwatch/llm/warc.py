"""WARC archives: write records with duplicate payloads as revisits, read them back by boundary-chain verification.

Writing uses Spark's text writer with a record's two line ends as its line separator: one file per task and at most
``records_per_file`` records each, so that large inputs become many archives. Of equal payloads, the one with the largest
page id is stored, the others refer to it.

Reading splits archives at every ``WARC/1.1`` line, as ranges of large files in parallel; payloads may hold such lines
too. Each piece is a candidate record and its length header names the offset of its successor. Runs of pieces that
follow each other are one step; pointer jumping over the runs, from offset 0 of each file, doubles the distance known
with every round, and only pieces reached from there are records. Pieces inside a payload are put back into it.

Cases: a null payload is empty; null page ids are the smallest, and a group of equal payloads without any page id is all
responses; rows with the same page id and payload are of one kind. Line ends in urls are escaped. A truncated last
record is not returned. Empty tables give archives without records. Columns besides id, url and payload are not stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duskwatch.session import stage

MAGIC = "WARC/1.1\r\n"
GAP = "\r\n\r\n"
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32: each 5 bytes are 8 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def with_kind(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Add digest, record_type and refers_to to (page_id, url, payload)."""
    rows = pages.withColumn("digest", sha1_base32(F.col("payload")))
    groups = stage(rows.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("first_id")), "warc-groups")
    revisits = (F.octet_length("payload") >= min_bytes) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(groups, "digest", "left").withColumn("record_type", F.when(revisits, "revisit").otherwise("response")).withColumn(
        "refers_to", F.when(F.col("record_type") == "revisit", F.col("first_id"))
    )


def write_warc(pages: DataFrame, path: str, *, page_id: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0, records_per_file: int = 20000, compression: str = "gzip") -> None:
    """Write one record per row below ``path``."""
    body = F.coalesce(F.col(f"`{payload}`"), F.lit(""))
    rows = with_kind(pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), body.alias("payload")), min_bytes)
    is_revisit = F.col("record_type") == "revisit"
    safe_url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))
    stored = F.when(is_revisit, F.lit("")).otherwise(F.col("payload"))
    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id"), F.lit(">"))),
        line("WARC-Target-URI", safe_url),
        line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to"), F.lit(">"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Payload-Length", F.octet_length("payload")),
        line("Content-Length", F.octet_length(stored)),
        F.lit("\r\n"),
        stored,
    )
    rows.select(record.alias("value")).write.option("lineSep", GAP).option("maxRecordsPerFile", records_per_file).option("compression", compression).text(path)


def header(head: Column, name: str) -> Column:
    found = F.regexp_extract(head, rf"(?m)^{name}: ([^\r\n]*)\r?$", 1)
    return F.when(found != "", found)


def pieces_of(spark: SparkSession, path: str) -> DataFrame:
    """What follows each magic line, in reading order (n) within a file's block, with the header and body it would have."""
    raw = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"), F.col("value").cast("binary").alias("bytes")
    )
    gap = F.expr(f"position(X'{GAP.encode().hex()}', bytes)")
    head = F.substring("bytes", 1, F.greatest(gap, F.lit(1)) + 1).cast("string")
    parsed = raw.withColumn("head", head).withColumn("body_at", F.when(gap > 0, gap + len(GAP))).withColumn("size", header(F.col("head"), "Content-Length").try_cast("long"))
    body = F.expr("substring(bytes, body_at, CAST(size AS INT))")
    return stage(parsed.withColumn("length", F.octet_length("bytes") + len(MAGIC)).withColumn("read", F.octet_length(body)).withColumn("digest", sha1_base32(body)), "warc-pieces")


def candidates(pieces: DataFrame) -> DataFrame:
    """Offsets of the pieces and of their successors: (n, file, at, next_at, succ).

    Offsets are running sums of lengths, first within a block, then over a file's blocks. Before a file's first magic
    line stands an empty piece, so a piece begins one magic line before its sum.
    """
    slim = pieces.select("file", "block", "n", "length", (len(MAGIC) + F.col("body_at") - 1 + F.col("size") + len(GAP)).alias("span"))
    before = lambda w: F.coalesce(F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = slim.groupBy("file", "block").agg(F.sum("length").alias("length")).select("file", "block", before(Window.partitionBy("file").orderBy("block")).alias("start"))
    own = slim.withColumn("own", before(Window.partitionBy("file", "block").orderBy("n")))
    at = own.join(starts, ["file", "block"]).withColumn("at", F.col("start") + F.col("own") - len(MAGIC)).where("at >= 0")
    return at.select("n", "file", "at", (F.col("at") + F.col("length")).alias("next_at"), (F.col("at") + F.col("span")).alias("succ"))


def reached(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(file, at) of the pieces reached from offset 0 by (file, at, next_at, succ)."""
    jumps = edges.where("succ IS NOT NULL AND succ <> next_at").select("file", F.col("succ").alias("at")).distinct().withColumn("entered", F.lit(True))
    by_file = Window.partitionBy("file").orderBy("at")
    marked = edges.join(jumps, ["file", "at"], "left").withColumn("follows", F.coalesce(F.lag("succ").over(by_file) == F.col("at"), F.lit(False)))
    head = ~F.col("follows") | F.col("entered").isNotNull()
    runs = stage(marked.withColumn("run", F.max(F.when(head, F.col("at"))).over(by_file)).select("file", "at", "next_at", "succ", "run"), "warc-runs")
    steps = runs.groupBy("file", "run").agg(F.max_by("succ", "at").alias("to"))
    known, steps = stage(steps.where("run = 0").select("file", "run"), "warc-known"), stage(steps, "warc-steps")
    size = known.count()
    for _ in range(max_rounds):
        onward = steps.join(known, ["file", "run"]).select("file", F.col("to").alias("run")).join(steps.select("file", "run"), ["file", "run"], "left_semi")
        known = stage(known.unionByName(onward).distinct(), "warc-known")
        grown = known.count()
        if grown == size:
            break
        size = grown
        far = steps.select("file", F.col("run").alias("to"), F.col("to").alias("beyond"))
        steps = stage(steps.join(far, ["file", "to"], "left").select("file", "run", F.coalesce("beyond", "to").alias("to")), "warc-steps")
    return runs.join(known, ["file", "run"], "left_semi").select("file", "at")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``: file, at, record_type, page_id, url, refers_to, digest, payload_bytes and payload.

    A payload is null for revisits, whose digest and length are the header's; others' are computed from what was read.
    """
    pieces = pieces_of(spark, path)
    spots = stage(candidates(pieces), "warc-candidates")
    good = stage(spots.join(reached(spots), ["file", "at"], "left_semi"), "warc-records")
    records = pieces.drop("file").join(good.select("n", "file", "at", "succ"), "n")
    # a record whose payload holds magic lines goes on in the pieces up to its successor
    broken = stage(good.where("succ > next_at"), "warc-broken")
    open_record = F.last(F.when(F.col("own"), F.struct("at", "succ")), ignorenulls=True).over(Window.partitionBy("file").orderBy("at"))
    own = good.select("n").withColumn("own", F.lit(True))
    inside = spots.join(broken.select("file").distinct(), "file", "left_semi").join(own, "n", "left").withColumn("own", F.coalesce("own", F.lit(False))).withColumn("of", open_record)
    parts = inside.join(broken.select("file", F.col("at").alias("whole")), (F.col("of.at") == F.col("whole")) & (inside.file == broken.file)).where(F.col("at") < F.col("of.succ"))
    glued = (
        parts.select("n", inside.file, "at", "whole").join(pieces.select("n", "bytes", "body_at", "size"), "n")
        .groupBy("file", "whole").agg(F.array_sort(F.collect_list(F.struct("at", "bytes", "body_at", "size"))).alias("parts"))
        .withColumn("joined", F.expr(f"reduce(slice(parts, 2, size(parts)), parts[0].bytes, (a, p) -> concat(a, X'{MAGIC.encode().hex()}', p.bytes))"))
        .select("file", F.col("whole").alias("at"), F.expr("substring(joined, parts[0].body_at, CAST(parts[0].size AS INT))").alias("glued"))
    )
    kind = header(F.col("head"), "WARC-Type")
    revisit = kind == "revisit"

    def number(name: str) -> Column:
        return F.regexp_extract(header(F.col("head"), name), "<urn:page:(-?[0-9]+)>", 1).try_cast("long")

    return (
        records.join(stage(glued, "warc-glued"), ["file", "at"], "left")
        .where(F.coalesce(F.octet_length("glued"), F.col("read")) == F.col("size"))
        .select(
            "file", "at", kind.alias("record_type"), number("WARC-Record-ID").alias("page_id"), header(F.col("head"), "WARC-Target-URI").alias("url"), number("WARC-Refers-To").alias("refers_to"),
            F.when(revisit, F.regexp_extract(header(F.col("head"), "WARC-Payload-Digest"), "sha1:(.*)", 1)).when(F.col("glued").isNotNull(), sha1_base32(F.col("glued"))).otherwise(F.col("digest")).alias("digest"),
            F.when(revisit, header(F.col("head"), "WARC-Payload-Length").cast("long")).otherwise(F.col("size")).alias("payload_bytes"),
            F.when(~revisit, F.coalesce("glued", F.expr("substring(bytes, body_at, CAST(size AS INT))"))).alias("payload"),
        )
    )
