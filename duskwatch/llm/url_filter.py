"""URL filters: a sort-merge range join of urls with nested allow and block rules.

A host is written with its labels reversed (``a.example.com`` -> ``com.example.a``), so a rule for a host and all its
subdomains is a prefix, and a rule's path is a prefix below it: the rule is the interval of keys from its own key to
that key followed by a byte that no UTF-8 text holds. Intervals of prefixes nest or are disjoint. A url belongs to each
of its host's zones (``com``, ``com.example``, ...), a handful of keys a url; in each zone rules and urls are sorted
together by path and the innermost open rule is carried along. The stack of open rules is held as one window per depth.

Cases: a null url, or one without ``://``, has empty host and path and fits no rule. Rules without a host or verdict are
ignored, a null path is empty, of rules with equal host and path ``block`` wins. The longest rule string wins, at equal
length the one with the longer host. Repeated urls each get their row; other columns of the urls are kept, but columns
named host, path, rule or verdict are replaced. Empty tables give empty results, or the default for every url.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.session import stage

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def zone_of(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def zones_of(host: Column, most: int) -> Column:
    """The reversed host cut after each of its first ``most`` labels."""
    return F.transform(
        F.array(F.slice(F.reverse(F.split(host, r"\.")), 1, max(most, 1))),
        lambda ls: F.transform(F.sequence(F.lit(1), F.size(ls)), lambda i: F.array_join(F.slice(ls, 1, i), ".")),
    )[0]


def rule_borders(rules: DataFrame) -> DataFrame:
    """Per zone the sorted points where the innermost open rule changes: (zone, at, top); top.rule is null where none is open."""
    clean = (
        rules.where("host IS NOT NULL AND verdict IS NOT NULL")
        .select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .groupBy("host", "path")
        .agg(F.max(F.struct((F.col("verdict") == "block").alias("blocks"), "verdict")).alias("v"))
        .select(
            zone_of(F.col("host")).alias("zone"),
            F.col("path").cast("binary").alias("start"),
            F.struct(F.concat("host", "path").alias("rule"), F.col("v.verdict").alias("verdict"), F.length("host").alias("host_length")).alias("own"),
        )
    )
    ends = F.concat(F.col("start"), F.lit(b"\xff"))
    marks = clean.select("zone", F.col("start").alias("at"), "own", F.lit(1).alias("step")).unionByName(
        clean.select("zone", ends.alias("at"), F.lit(None).cast(clean.schema["own"].dataType).alias("own"), F.lit(-1).alias("step"))
    )
    in_zone = Window.partitionBy("zone").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    at_depth = Window.partitionBy("zone", "depth").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    none = F.lit(None).cast(clean.schema["own"].dataType)
    return marks.withColumn("depth", F.sum("step").over(in_zone)).select(
        "zone", "at", F.when(F.col("depth") > 0, F.last("own", ignorenulls=True).over(at_depth)).otherwise(none).alias("top")
    )


def judge_urls(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add host, path, rule and verdict to each url; rules have host, path and verdict.

    Each zone's keys are dealt over about the square root of their number of tasks, so that
    neither a hot zone nor the copies of its rules grow large.
    """
    spark = urls.sparkSession
    keep = [c for c in urls.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    parts = urls.select(*[F.col(f"`{c}`") for c in keep], host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    keys = stage(parts.select("host", "path").distinct(), "url-keys")
    borders = stage(rule_borders(rules), "url-rules")
    most = borders.agg(F.max(F.size(F.split("zone", r"\.")))).first()[0] or 0  # no rule's zone has more labels
    spots = keys.select("host", "path", F.explode(zones_of(F.col("host"), most)).alias("zone"))
    fans = stage(
        spots.groupBy("zone").count().join(borders.select("zone").distinct(), "zone").select("zone", F.ceil(F.sqrt("count")).cast("int").alias("fan")),
        "url-fans",
    )
    points = spots.join(fans, "zone").select(
        "zone", F.pmod(F.xxhash64("host", "path"), "fan").cast("int").alias("salt"), F.col("path").cast("binary").alias("at"),
        F.lit(1).alias("is_url"), F.lit(None).cast(borders.schema["top"].dataType).alias("top"), "host", "path",
    )
    marks = borders.join(fans, "zone").select(
        "zone", F.explode(F.sequence(F.lit(0), F.col("fan") - 1)).alias("salt"), "at", F.lit(0).alias("is_url"),
        F.coalesce("top", F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in borders.schema["top"].dataType])).alias("top"),
        F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path"),
    )
    sweep = Window.partitionBy("zone", "salt").orderBy("at", "is_url").rowsBetween(Window.unboundedPreceding, 0)
    hits = points.unionByName(marks).withColumn("open", F.last("top", ignorenulls=True).over(sweep)).where("is_url = 1 AND open.rule IS NOT NULL")
    best = hits.groupBy("host", "path").agg(
        F.max(F.struct(F.length("open.rule"), F.col("open.host_length"), F.col("open.rule").alias("rule"), F.col("open.verdict").alias("verdict"))).alias("best")
    )
    judged = stage(best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict")), "url-judged")
    return parts.join(judged, ["host", "path"], "left").select(*[F.col(f"`{c}`") for c in keep], "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
