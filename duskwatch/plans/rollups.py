"""Queries on maintained rollups. They are built once per session and folder, from all stored events in four batches of many files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.operators import reports
from duskwatch.plans.counts import NOW
from duskwatch.plans.registry import SQL, query
from duskwatch.session import work_dir
from duskwatch.sources.telemetry import Telemetry
from duskwatch.streaming import rollups
from duskwatch.streaming.run import landing_files, stream_parquet

BUILT: dict[tuple[str, str], str] = {}
CARD_NOW = datetime(2024, 1, 30, 20)


def build(t: Telemetry) -> str:
    landed, path = work_dir(t.spark, "rollup-in"), work_dir(t.spark, "rollups")
    timed = t.stored.withColumn("event_time", F.timestamp_micros("ts_us")).select(*rollups.NEEDED)
    timed.repartition(4 * landing_files(t.spark), F.xxhash64("ts", "eventid")).write.parquet(landed)
    written = len(t.spark.read.parquet(landed).inputFiles())  # empty ones are not written
    stream = stream_parquet(t.spark, landed, files_per_batch=-(-written // 4))
    rollups.maintain_rollups(stream, path, work_dir(t.spark, "checkpoint"), fold=2)
    return path


def built(t: Telemetry) -> str:
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in BUILT:
        BUILT[key] = build(t)
    return BUILT[key]


@query("rollup_build", "SELECT * FROM counters")
def rollup_build(t: Telemetry) -> DataFrame:
    """All counters after four micro-batches that cut sessions apart, techniques among them."""
    path = BUILT[(t.spark.sparkContext.applicationId, t.folder)] = build(t)
    tables = rollups.hours(t.spark, path).read(), rollups.techniques(t.spark, path).read().filter("count <> 0")
    return tables[0].unionByName(tables[1]).select("bucket", "dimension", "value", "count")


@query("rollup_ranks", SQL["top_ranks"])
def rollup_ranks(t: Telemetry) -> DataFrame:
    return rollups.ranks(t.spark, built(t), NOW).withColumn("rank", F.col("rank").cast("bigint"))


@query("rollup_top_list", SQL["top_list"])
def rollup_top_list(t: Telemetry) -> DataFrame:
    ranked = reports.top_lists(rollups.ranks(t.spark, built(t), NOW), 20)
    return ranked.select("dimension", "window", F.col("rank").cast("bigint").alias("rank"), "value", "count")


@query("rollup_daily", SQL["daily_summary"])
def rollup_daily(t: Telemetry) -> DataFrame:
    return rollups.daily_summaries(t.spark, built(t))


@query("rollup_today", SQL["today_summary"])
def rollup_today(t: Telemetry) -> DataFrame:
    return rollups.daily_summaries(t.spark, built(t), between=("2024-01-30", "2024-01-30"))


@query("rollup_breakdown", SQL["technique_breakdown"])
def rollup_breakdown(t: Telemetry) -> DataFrame:
    both = rollups.breakdown(t.spark, built(t), NOW, {"24h": 24, "7d": 168})
    return both.withColumn("lo", F.when(F.col("span") == "24h", "2024-01-30T01").otherwise("2024-01-24T01"))


@query("rollup_timeline_hourly", SQL["timeline_hourly"])
def rollup_timeline_hourly(t: Telemetry) -> DataFrame:
    return rollups.timeline_hourly(t.spark, built(t), NOW, "30d")


@query("rollup_timeline_daily", SQL["timeline_daily"])
def rollup_timeline_daily(t: Telemetry) -> DataFrame:
    return rollups.timeline_daily(t.spark, built(t), NOW, "30d")


@query(
    "rollup_card",
    """SELECT count(*) FILTER (substr(ts, 1, 10) = '2024-01-30') AS total, count(*) FILTER (substr(ts, 1, 10) = '2024-01-30') AS last_24h,
  CAST(0 AS BIGINT) AS last_1h, count(DISTINCT CASE WHEN substr(ts, 1, 10) = '2024-01-30' AND src_ip <> '' THEN src_ip END) AS unique_ips_24h,
  max(ts) AS sensor_last_seen FROM hp""",
)
def rollup_card(t: Telemetry) -> DataFrame:
    return rollups.summary_card(t.spark, built(t), CARD_NOW)
