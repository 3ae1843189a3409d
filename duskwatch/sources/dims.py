"""Dimension and threat-feed loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.functions.net import IPV4_PATTERN, cidr_hi, cidr_lo

_POOLS = "pools ARRAY<STRUCT<asn: BIGINT, asn_org: STRING, country: STRING, weight: BIGINT, cidrs: ARRAY<STRING>>>"


def geo_ranges_from_pools(pools: DataFrame) -> DataFrame:
    """Pools with CIDR lists as one ``[lo, hi]`` row per CIDR; unreadable CIDRs are dropped."""
    one = pools.withColumn("cidr", F.explode("cidrs"))
    return one.select(
        cidr_lo(F.col("cidr")).alias("lo"), cidr_hi(F.col("cidr")).alias("hi"), "country", "asn", "asn_org"
    ).filter(F.col("lo").isNotNull() & F.col("hi").isNotNull())


def load_geo_ranges(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """Pool documents (``{"pools": [...]}``, one per file, or one per line) as ranges."""
    docs = spark.read.schema(_POOLS).option("multiLine", multi_line).json(path)
    return geo_ranges_from_pools(docs.select(F.inline("pools")))


def load_address_ranges(spark: SparkSession, path: str, *, multi_line: bool = True) -> DataFrame:
    """The same documents as ranges of both address families: a network (``first``) a row; unreadable ones match nothing."""
    docs = spark.read.schema(_POOLS).option("multiLine", multi_line).json(path)
    return docs.select(F.inline("pools")).select(
        F.explode("cidrs").alias("first"), F.lit(None).cast("string").alias("last"), "country", "asn", "asn_org"
    )


def load_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """One literal per line; blanks, ``#`` lines and repeats are dropped."""
    word = F.regexp_replace("value", r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    return (
        spark.read.text(path).select(word.alias("word")).filter((F.col("word") != "") & ~F.col("word").startswith("#"))
    ).distinct()


def scan_csv_feed(spark: SparkSession, path: str, feed: str, *, columns: str, value: str, kind: str) -> DataFrame:
    """Delimited feed with ``#`` comments; ``value`` names the indicator column of ``columns``."""
    rows = spark.read.schema(columns).option("comment", "#").csv(path)
    return _indicator(rows, F.col(value), kind, feed)


def scan_text_feed(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """Free text: every line that starts with an IPv4 address."""
    first = F.regexp_extract("value", r"^\s*([0-9.]+)", 1)
    rows = spark.read.text(path).select(first.alias("v")).filter(F.col("v").rlike(IPV4_PATTERN))
    return _indicator(rows, F.col("v"), "ip", feed)


def scan_json_feed(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """Indicator events: ``{"Event": {"id", "info", "threat_level_id", "Attribute": [{"type", "value"}]}}``."""
    schema = (
        "Event STRUCT<id: STRING, info: STRING, threat_level_id: STRING, "
        "Attribute: ARRAY<STRUCT<type: STRING, value: STRING>>>"
    )
    rows = spark.read.schema(schema).json(path).select("Event.*").withColumn("a", F.explode("Attribute"))
    return rows.select(
        F.when(F.col("a.type").isin("ip-src", "ip-dst"), "ip").otherwise(F.col("a.type")).alias("kind"),
        F.col("a.value").alias("value"),
        F.col("id").alias("indicator_event_id"),
        F.col("threat_level_id").try_cast("bigint").alias("threat_level"),
        "info",
        F.lit(feed).alias("feed"),
        F.lit("tlp:white").alias("tag"),
    )


def _indicator(rows: DataFrame, value, kind: str, feed: str) -> DataFrame:
    return rows.select(
        F.lit(kind).alias("kind"),
        F.trim(value).alias("value"),
        F.lit(None).cast("string").alias("indicator_event_id"),
        F.lit(None).cast("bigint").alias("threat_level"),
        F.lit(None).cast("string").alias("info"),
        F.lit(feed).alias("feed"),
        F.lit("tlp:white").alias("tag"),
    ).filter(F.col("value").isNotNull() & (F.col("value") != ""))
