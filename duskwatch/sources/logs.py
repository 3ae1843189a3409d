"""Scans of honeypot, proxy and generic JSON logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.functions.timefns import iso_to_us, us_to_iso
from duskwatch.operators.validate import check_events, compute_once
from duskwatch.schemas import EVENT_FIELDS, GIVEN_FIELDS, PROXY_FIELDS, TRANSPORT_FIELDS, all_strings

PROXY_LINE = (
    r"^([^ ]+) ([^ ]+) (haproxy)\[(\d+)\]: client=([0-9.]+):(\d+) frontend_port=(\d+) "
    r"duration=([+-]?\d+) bytes_uploaded=([+-]?\d+) bytes_downloaded=([+-]?\d+) status=(\S+)"
)


def read_lines(spark: SparkSession, path: str | list[str], *, streaming: bool = False) -> DataFrame:
    """Text or gzip objects line by line, with the object's path; blank lines are skipped."""
    reader = spark.readStream if streaming else spark.read
    lines = reader.option("recursiveFileLookup", "true").format("text").load(path)
    return lines.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("object_path")).filter(
        F.trim("line") != ""
    )


def read_partitioned(spark: SparkSession, base: str, *, streaming: bool = False) -> DataFrame:
    """Lines of objects below ``date=<day>/host=<name>`` folders with these as partition columns: a filter on them opens only their folders."""
    reader = spark.readStream if streaming else spark.read
    lines = reader.schema("value STRING, date STRING, host STRING").option("basePath", base).format("text").load(base)
    path = F.col("_metadata.file_path")
    return lines.select(
        F.col("value").alias("line"), path.alias("object_path"), source_kind(path).alias("kind"), "date", "host"
    ).filter(F.trim("line") != "")


def parse_events(lines: DataFrame, *, strict: bool = False) -> DataFrame:
    """Event lines as all-text wire fields with a ``malformed`` flag; ``strict`` fails on a bad line."""
    schema = all_strings((*EVENT_FIELDS, *TRANSPORT_FIELDS, *GIVEN_FIELDS), ("_bad",))
    parsed = F.from_json("line", schema, {"columnNameOfCorruptRecord": "_bad"})
    bad = F.col("e").isNull() | F.col("e._bad").isNotNull()
    if strict:
        bad = F.when(bad, F.raise_error(F.concat(F.lit("not JSON: "), F.col("line"))).cast("boolean")).otherwise(False)
    return compute_once(lines, e=parsed).select(
        "line", "object_path", bad.alias("malformed"), *[F.col(f"e.{f.name}") for f in schema.fields if f.name != "_bad"]
    )


def scan_events(spark: SparkSession, path: str | list[str], *, strict: bool = False) -> DataFrame:
    return parse_events(read_lines(spark, path), strict=strict)


def parse_proxy(lines: DataFrame) -> DataFrame:
    """Proxy JSON lines, one row each; ``parsed`` is false when a required field is missing or wrong."""
    schema = all_strings(PROXY_FIELDS)
    return _typed_proxy(compute_once(lines, p=F.from_json("line", schema)))


def parse_proxy_text(lines: DataFrame) -> DataFrame:
    """Raw proxy syslog lines."""
    fields = F.struct(
        *[
            F.nullif(F.regexp_extract("line", PROXY_LINE, i + 1), F.lit("")).alias(name)
            for i, name in enumerate(PROXY_FIELDS)
        ]
    )
    return _typed_proxy(compute_once(lines, p=fields))


def _typed_proxy(df: DataFrame) -> DataFrame:
    def whole(name: str):
        text = F.col(f"p.{name}")
        return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(text).try_cast("bigint"))

    def optional(name: str):
        return F.when(F.col(f"p.{name}").isNull(), F.lit(0).cast("bigint")).otherwise(whole(name))

    us = iso_to_us(F.col("p.time"))
    out = df.select(
        "line",
        "object_path",
        us.alias("ts_us"),
        us_to_iso(us, "+00:00").alias("ts"),
        F.col("p.client_ip").alias("client_ip"),
        whole("client_port").alias("client_port"),
        whole("frontend_port").alias("frontend_port"),
        optional("duration").alias("duration"),
        optional("bytes_uploaded").alias("bytes_uploaded"),
        optional("bytes_downloaded").alias("bytes_downloaded"),
        F.coalesce(F.col("p.status"), F.lit("")).alias("status"),
    )
    needed = ("ts_us", "client_ip", "client_port", "frontend_port", "duration", "bytes_uploaded", "bytes_downloaded")
    ok = F.lit(True)
    for name in needed:
        ok = ok & F.col(name).isNotNull()
    return out.withColumn("parsed", ok)


PROXY_COLUMNS = (
    "ts", "ts_us", "client_ip", "client_port", "frontend_port", "duration", "bytes_uploaded", "bytes_downloaded",
    "status",
)


def scan_proxy(spark: SparkSession, path: str | list[str], *, text: bool = False) -> DataFrame:
    """Parsed proxy connections; malformed lines are dropped (``ingest_audit`` counts them)."""
    lines = read_lines(spark, path)
    return (parse_proxy_text(lines) if text else parse_proxy(lines)).filter("parsed").select(*PROXY_COLUMNS)


def source_kind(object_path):
    """``proxy`` for objects under raw/haproxy/, ``event`` for all other raw/ objects."""
    return F.when(object_path.contains("/raw/haproxy/"), "proxy").when(object_path.contains("/raw/"), "event")


def route_sources(lines: DataFrame) -> DataFrame:
    """Add the source kind and the ``date=`` / ``host=`` parts of each line's path."""
    path = F.col("object_path")

    def part(name: str):
        return F.nullif(F.regexp_extract(F.url_decode(path), f"/{name}=([^/]+)/", 1), F.lit(""))

    return lines.withColumn("kind", source_kind(path)).withColumn("date", part("date")).withColumn("host", part("host"))


def ingest_audit(lines: DataFrame) -> DataFrame:
    """Read, validated, written and rejected rows per object, and the grand total under ``*``.

    Rows of an event object are written once per (session, timestamp, eventid).
    """
    events = check_events(parse_events(lines.filter(source_kind(F.col("object_path")) == "event"))).select(
        "object_path",
        (~F.col("malformed") & (F.size("failed_rules") == 0)).alias("ok"),
        F.concat_ws("|", "session", "timestamp", "eventid").alias("key"),
    )
    proxy = parse_proxy(lines.filter(source_kind(F.col("object_path")) == "proxy")).select(
        "object_path", F.col("parsed").alias("ok"), F.concat_ws("|", "ts", "client_port").alias("key")
    )
    per_object = (
        events.unionByName(proxy)
        .groupBy("object_path")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_if("ok").alias("validated"),
            F.count_distinct(F.when(F.col("ok"), F.col("key"))).alias("written"),
            F.count_if(~F.col("ok")).alias("errors"),
        )
    )
    sums = [F.sum(c).alias(c) for c in ("lines", "validated", "written", "errors")]
    return per_object.withColumn("objects", F.lit(1).cast("bigint")).unionByName(
        per_object.agg(*sums, F.count(F.lit(1)).alias("objects")).withColumn("object_path", F.lit("*"))
    )


def scan_json_logs(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """JSON logs with their keys at the root; a line that does not parse is kept under ``json_error``."""
    return (
        spark.read.schema(f"{schema}, json_error STRING")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "json_error")
        .json(path)
    )
