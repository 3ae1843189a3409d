"""Event sink, partitioned exports, retention."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.functions.timefns import DAY_US, HOUR_US, day_key
from duskwatch.sources.store import EVENT_KEY, AppendTable, event_store

# Days or hours a record kind is kept (fixed values), counted from its own time.
RETENTION_US = {
    "event": 90 * DAY_US,
    "proxy": 90 * DAY_US,
    "hourly": 60 * DAY_US,
    "rank": 26 * HOUR_US,
    "summary": 365 * DAY_US,
    "dedup": HOUR_US,
}


def sink_events(events: DataFrame, path: str, *, batch: int | None = None, arrival: str | None = None) -> bool:
    """Append a batch of events to the store; (session, ts, eventid) is the key and the last arrival wins.

    A batch number that is in already adds nothing; without one, the batch is the next. Only new files are written.
    """
    store = event_store(events.sparkSession, path)
    dated = events.withColumn("day", day_key(F.col("ts")))
    last = Window.partitionBy(*EVENT_KEY).orderBy(F.lit(0) if arrival is None else F.desc(arrival))
    once = dated.withColumn("__n", F.row_number().over(last)).filter("__n = 1").drop("__n")
    return store.append(once, store.manifest().applied + 1 if batch is None else batch)


def export_partitioned(events: DataFrame, path: str, columns: Sequence[str], *, by: str = "day") -> DataFrame:
    """Time-sorted gzip NDJSON per UTC day or hour; returns the manifest of rows and checksum.

    The checksum adds up 32 bits of each line's hash, so it does not depend on line order.
    """
    if by not in ("day", "hour"):
        raise ValueError("by must be day or hour")
    width = {"day": 10, "hour": 13}[by]
    lines = events.select(
        F.substring("ts", 1, width).alias(by), "ts", F.to_json(F.struct(*columns)).alias("value")
    )
    (
        lines.repartitionByRange(F.col(by), F.col("ts"))
        .sortWithinPartitions(by, "ts")
        .drop("ts")
        .write.mode("overwrite")
        .partitionBy(by)
        .option("compression", "gzip")
        .text(path)
    )
    written = events.sparkSession.read.schema(f"value STRING, {by} STRING").text(path)
    return manifest(written, by)


def manifest(lines: DataFrame, by: str) -> DataFrame:
    bits = F.conv(F.substring(F.md5("value"), 1, 8), 16, 10).cast("bigint")
    return lines.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.sum(bits).alias("checksum"))


def sink_routed(unified: DataFrame, path: str) -> None:
    """Write a unified log stream below category and UTC date."""
    (
        unified.withColumn("date", F.date_format("event_time", "yyyy-MM-dd"))
        .hint("rebalance", F.col("category"), F.col("date"))
        .write.mode("overwrite")
        .partitionBy("category", "date")
        .parquet(path)
    )


def expires_at_us(kind: str, ts_us: Column) -> Column:
    return ts_us + F.lit(RETENTION_US[kind])


def retained(df: DataFrame, kind: str, ts_us: str, now_us: int) -> DataFrame:
    """Rows that have not expired. The test is on the time column itself, so it reaches the scan."""
    return df.filter(F.col(ts_us) > F.lit(now_us - RETENTION_US[kind])).withColumn(
        "expires_us", expires_at_us(kind, F.col(ts_us))
    )


def drop_expired(table: AppendTable, kind: str, now_us: int) -> int:
    """Let the whole days go whose last instant has expired, as one change of the manifest; returns how many.

    ``retained`` still cuts the border day. A repeat of an old batch brings nothing back.
    """
    border = datetime.fromtimestamp((now_us - RETENTION_US[kind]) // 1_000_000, timezone.utc).strftime("%Y-%m-%d")
    gone = table.expire(border)
    table.vacuum(1)
    return gone
