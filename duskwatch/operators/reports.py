"""Read-side reports; parameters are range-checked and the clock is always passed in."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.functions.timefns import day_key
from duskwatch.operators.projections import public_events
from duskwatch.operators.rollup import hour_bounds

HOURS = {"24h": 24, "7d": 168, "30d": 720}


def _check(name: str, value, allowed) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {list(allowed)}, got {value!r}")


def _check_limit(limit: int, most: int) -> None:
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be between 1 and {most}, got {limit}")


def timeline_hourly(
    counters: DataFrame, now: datetime, window: str = "24h", unavailable: Sequence[str] = ()
) -> DataFrame:
    """One row per hour ending with the current one; empty hours are 0, unavailable ones null."""
    _check("window", window, HOURS)
    lo, hi = hour_bounds(now, HOURS[window])
    spark = counters.sparkSession
    spine = spark.range(HOURS[window]).select(
        F.date_format(
            F.timestamp_seconds(F.unix_timestamp(F.lit(lo), "yyyy-MM-dd'T'HH") + F.col("id") * 3600),
            "yyyy-MM-dd'T'HH",
        ).alias("bucket")
    )
    totals = (
        counters.filter((F.col("dimension") == "eventid") & F.col("bucket").between(lo, hi))
        .groupBy("bucket")
        .agg(F.sum("count").alias("count"))
    )
    count = F.coalesce(F.col("count"), F.lit(0).cast("bigint"))
    if unavailable:
        count = F.when(~F.col("bucket").isin(*unavailable), count)
    return spine.join(totals, "bucket", "left").select(
        F.concat("bucket", F.lit(":00:00Z")).alias("ts"), count.alias("count")
    )


def timeline_daily(summaries: DataFrame, now: datetime, window: str = "7d") -> DataFrame:
    """One row per day ending today; a missing summary is 0."""
    _check("window", window, HOURS)
    days = max(1, HOURS[window] // 24)
    first = now.date() - timedelta(days=days - 1)
    spine = summaries.sparkSession.range(days).select(
        F.date_format(F.date_add(F.lit(first.isoformat()).cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias(
            "day"
        )
    )
    totals = summaries.filter(F.col("day").between(first.isoformat(), now.date().isoformat())).select(
        "day", "total_events"
    )
    return spine.join(totals, "day", "left").select(
        F.concat("day", F.lit("T00:00:00Z")).alias("ts"),
        F.coalesce(F.col("total_events"), F.lit(0).cast("bigint")).alias("count"),
    )


def events_page(
    events: DataFrame, day: str, limit: int = 50, before: tuple[str, str, str] | None = None
) -> DataFrame:
    """Newest-first page of one day. ``before`` is the (ts, session, eventid) of the last row seen.

    ``next_before`` is set on every row of a full page and null on the last page.
    """
    _check_limit(limit, 200)
    src = events.filter(day_key(F.col("ts")) == day)
    if before is not None:
        cursor = F.struct(*[F.lit(v).alias(n) for n, v in zip(("ts", "session", "eventid"), before)])
        src = src.filter(F.struct("ts", "session", "eventid") < cursor)
    page = public_events(src).orderBy(F.desc("ts"), F.desc("session"), F.desc("eventid")).limit(limit)
    whole_page = Window.partitionBy(F.lit(0))
    full = F.count(F.lit(1)).over(whole_page) >= limit
    return page.withColumn("next_before", F.when(full, F.min("ts").over(whole_page)))


def session_log(events: DataFrame, session: str) -> DataFrame:
    if not session:
        raise ValueError("session is required")
    return public_events(events.filter(F.col("session") == session)).orderBy("ts", "eventid")


def ip_history(events: DataFrame, ip: str) -> DataFrame:
    return public_events(events.filter(F.col("src_ip") == ip)).orderBy(F.desc("ts"), F.desc("session"), F.desc("eventid"))


LISTED = ("username", "password", "country")


def top_lists(ranks: DataFrame, limit: int = 20) -> DataFrame:
    """All lists of both windows in one pass over the ranking."""
    _check_limit(limit, 50)
    return ranks.filter(F.col("dimension").isin(*LISTED) & (F.col("rank") <= limit))


def top_list(ranks: DataFrame, dimension: str, window: str = "24h", limit: int = 20) -> DataFrame:
    _check("dimension", dimension, LISTED)
    _check("window", window, ("24h", "7d"))
    _check_limit(limit, 50)
    return ranks.filter(
        (F.col("window") == window.upper()) & (F.col("dimension") == dimension) & (F.col("rank") <= limit)
    ).select("rank", "value", "count")


def top_asns(
    ranks: DataFrame, window: str = "24h", limit: int = 10, organisations: DataFrame | None = None
) -> DataFrame:
    """ASN ranking; the organisation is null unless an (asn, asn_org) table is given."""
    _check("window", window, ("24h", "7d"))
    _check_limit(limit, 25)
    rows = (
        ranks.filter((F.col("window") == window.upper()) & (F.col("dimension") == "asn") & (F.col("rank") <= limit))
        .withColumn("asn", F.col("value").try_cast("int").cast("bigint"))
        .filter(F.col("asn").isNotNull())
    )
    if organisations is None:
        return rows.select("rank", "asn", F.lit(None).cast("string").alias("asn_org"), "count")
    orgs = organisations.groupBy(F.col("asn").cast("bigint").alias("asn")).agg(F.min("asn_org").alias("asn_org"))
    return rows.join(orgs, "asn", "left").select("rank", "asn", "asn_org", "count")


def summary_card(events: DataFrame, now: datetime, mode: str = "ref") -> DataFrame:
    """Totals for the front page.

    ``ref`` reports today's UTC total as the last 24 hours and 0 as the last hour; ``true``
    counts the real trailing windows.
    """
    _check("mode", mode, ("ref", "true"))
    text = now.strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    today = day_key(F.col("ts")) == now.date().isoformat()
    last_day = F.col("ts").between((now - timedelta(hours=24)).strftime("%Y-%m-%dT%H:%M:%S.%fZ"), text)
    last_hour = F.col("ts").between((now - timedelta(hours=1)).strftime("%Y-%m-%dT%H:%M:%S.%fZ"), text)
    inside = today if mode == "ref" else last_day
    hour = F.lit(0).cast("bigint") if mode == "ref" else F.count_if(last_hour)
    return events.agg(
        F.count_if(today).alias("total"),
        F.count_if(inside).alias("last_24h"),
        hour.alias("last_1h"),
        F.count_distinct(F.when(inside, F.col("src_ip"))).alias("unique_ips_24h"),
        F.max("ts").alias("sensor_last_seen"),
    )


def observed_countries(ranks: DataFrame) -> DataFrame:
    """Countries with a positive count in the 24-hour ranking."""
    return ranks.filter((F.col("window") == "24H") & (F.col("dimension") == "country") & (F.col("count") > 0)).agg(
        F.count(F.lit(1)).alias("countries")
    )


def download_report(events: DataFrame, top: int = 10) -> DataFrame:
    """Number of downloads, top URLs and top hashes with a reputation link."""
    files = events.filter(F.col("eventid") == "cowrie.session.file_download")
    parts = F.explode(
        F.array(
            F.struct(F.lit("total").alias("kind"), F.lit("").alias("value")),
            F.struct(F.lit("url").alias("kind"), F.col("url").alias("value")),
            F.struct(F.lit("shasum").alias("kind"), F.col("shasum").alias("value")),
        )
    )
    counted = (
        files.select(parts.alias("p"))
        .groupBy(F.col("p.kind").alias("kind"), F.col("p.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("downloads"))
        .filter(F.col("value").isNotNull())
    )
    order = Window.partitionBy("kind").orderBy(F.desc("downloads"), F.asc("value"))
    return (
        counted.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .withColumn(
            "link",
            F.when(
                F.col("kind") == "shasum", F.concat(F.lit("https://www.virustotal.com/gui/file/"), F.col("value"))
            ),
        )
    )
