"""A maintained hierarchy of rollups, from which reports are read: hours, techniques, sets of each day, last sightings.

Each micro-batch appends what it adds and nothing else is written; readers add up, and folders are folded now and then.
Hours hold counts by dimension, days the distinct addresses and sessions as keyed sets with their number of events.
A closing's technique depends on its whole session, so the state of the sessions a batch touches is looked up by the
index, and the technique counts get the difference between the labels after the batch and before it. Late events thus
correct what was counted, and no report reads events.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.functions.timefns import day_key, hour_key
from duskwatch.operators import reports
from duskwatch.operators.rank import top_ranks
from duskwatch.operators.rollup import DOWNLOAD, SUCCESS, TECHNIQUES, hour_bounds, technique_breakdowns, technique_label, trailing_totals
from duskwatch.session import stage
from duskwatch.sources.store import AppendTable, summed
from duskwatch.streaming.counters import COUNTER, SESSION_KEY, SESSION_SUMS, counter_table, counts_of, session_parts, session_table
from duskwatch.streaming.run import drain_batches

NEEDED = ("ts", "event_time", "session", "src_ip", "eventid", "username", "password", "country", "asn", "input", "dst_port", "duration")


def hours(spark: SparkSession, path: str) -> AppendTable:
    return counter_table(spark, f"{path}/hours")


def techniques(spark: SparkSession, path: str) -> AppendTable:
    return AppendTable(spark, f"{path}/techniques", "day", summed(COUNTER, ("count",)))


def day_sets(spark: SparkSession, path: str) -> AppendTable:
    return AppendTable(spark, f"{path}/sets", "day", summed(("day", "kind", "value"), ("events",)))


def sightings(spark: SparkSession, path: str) -> AppendTable:
    return AppendTable(spark, f"{path}/seen", "day", lambda rows: rows.groupBy("day").agg(F.max("ts").alias("ts")))


def label_changes(before: DataFrame, parts: DataFrame) -> DataFrame:
    """What the technique counts per hour change by, when ``parts`` come on top of the state ``before`` of their sessions.

    Old and new totals and closings come from one pass each: a row of the state before is marked and counts for both.
    """

    def sums(*names: str) -> list:
        return [F.sum(c).alias(c) for c in names] + [F.sum(F.when(F.col("held"), F.col(c)).otherwise(0)).alias(f"{c}_before") for c in names]

    rows = before.select(*SESSION_KEY, *SESSION_SUMS, F.lit(True).alias("held")).unionByName(parts.select(*SESSION_KEY, *SESSION_SUMS, F.lit(False).alias("held")))
    names = rows.groupBy("session", "username").agg(*sums("failed", "succeeded"), F.max("held").alias("held"))
    logins = ("failed", "succeeded", "failed_before", "succeeded_before")
    known = [F.count("username").alias("names"), F.count(F.when(F.col("held"), F.col("username"))).alias("names_before")]
    totals = names.groupBy("session").agg(*[F.sum(c).alias(c) for c in logins], *known)
    short = F.when(F.col("duration_seconds") < 2.0, 0.0).otherwise(2.0)
    closed = rows.filter("closings > 0").groupBy("session", hour_key(F.col("ts")).alias("bucket"), short.alias("seconds")).agg(*sums("closings"))
    after = technique_label(F.col("seconds"), F.col("failed"), F.col("succeeded"), F.col("names"))
    was = technique_label(F.col("seconds"), F.col("failed_before"), F.col("succeeded_before"), F.col("names_before"))
    steps = F.array(F.struct(after.alias("value"), F.col("closings").alias("n")), F.struct(was.alias("value"), (-F.col("closings_before")).alias("n")))
    changes = closed.join(totals, "session").select("bucket", F.explode(steps).alias("s"))
    counted = changes.groupBy("bucket", F.lit("technique").alias("dimension"), F.col("s.value").alias("value")).agg(F.sum("s.n").alias("count"))
    return counted.filter(F.col("count") != 0).withColumn("day", F.substring("bucket", 1, 10)).select(*COUNTER, "count")


def maintain_rollups(stream: DataFrame, path: str, checkpoint: str, fold: int = 8) -> None:
    """Keep all rollups up to date with a stream of events (``NEEDED``); repeats of a batch change nothing."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        events = stage(batch.select(*NEEDED), "rollup-events")
        sessions = session_table(spark, f"{path}/sessions")
        if batch_id > sessions.manifest().applied:
            parts = stage(session_parts(events), "rollup-sessions")
            before = stage(sessions.rows_of("session", parts), "rollup-before") if sessions.exists() else parts.limit(0)
            techniques(spark, path).append(label_changes(before, parts), batch_id)  # before the state moves on
            sessions.append(parts, batch_id)
        hours(spark, path).append(counts_of(events), batch_id)
        dated = events.filter(F.col("ts").isNotNull()).withColumn("day", day_key(F.col("ts")))
        members = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in ("src_ip", "session")]))
        sets = dated.select("day", members.alias("m")).filter("m.value <> ''").groupBy("day", "m.kind", "m.value").agg(F.count(F.lit(1)).alias("events"))
        day_sets(spark, path).append(sets, batch_id)
        sightings(spark, path).append(dated.groupBy("day").agg(F.max("ts").alias("ts")), batch_id)
        for table in (sessions, techniques(spark, path), hours(spark, path), day_sets(spark, path), sightings(spark, path)):
            table.compact(fold)

    drain_batches(stream, on_batch, checkpoint)


def _days(now: datetime, count: int) -> tuple[str, str]:
    return (now.date() - timedelta(days=count - 1)).isoformat(), now.date().isoformat()


def ranks(spark: SparkSession, path: str, now: datetime) -> DataFrame:
    """The rankings of both trailing windows, from the hours of eight days."""
    span = _days(now, 8)
    both = hours(spark, path).read(between=span).unionByName(techniques(spark, path).read(between=span))
    return top_ranks(trailing_totals(both, now))


def breakdown(spark: SparkSession, path: str, now: datetime, spans: dict[str, int]) -> DataFrame:
    lo, hi = hour_bounds(now, max(spans.values()))
    return technique_breakdowns(techniques(spark, path).read(between=(lo[:10], hi[:10])), now, spans)


def timeline_hourly(spark: SparkSession, path: str, now: datetime, window: str = "24h") -> DataFrame:
    lo, hi = hour_bounds(now, reports.HOURS[window])
    return reports.timeline_hourly(hours(spark, path).read(between=(lo[:10], hi[:10])), now, window)


def daily_summaries(spark: SparkSession, path: str, between: tuple[str, str] | None = None) -> DataFrame:
    """One row per day with events: totals, distinct addresses and sessions, and the techniques as columns."""
    n = F.col("count")
    counted = hours(spark, path).read(between=between).filter(F.col("dimension") == "eventid").groupBy("day").agg(
        F.sum("count").alias("total_events"),
        F.sum(F.when(F.col("value") == SUCCESS, n).otherwise(0)).alias("successful_logins"),
        F.sum(F.when(F.col("value") == DOWNLOAD, n).otherwise(0)).alias("file_downloads"),
    )
    sets = day_sets(spark, path).read(between=between).groupBy("day").agg(
        F.count_if(F.col("kind") == "src_ip").alias("unique_ips"), F.count_if(F.col("kind") == "session").alias("unique_sessions")
    )
    labels = techniques(spark, path).read(between=between).groupBy("day").agg(
        *[F.sum(F.when(F.col("value") == t, n).otherwise(0)).alias(t) for t in TECHNIQUES]
    )
    joined = counted.join(sets, "day", "left").join(labels, "day", "left")
    columns = ("total_events", "unique_ips", "unique_sessions", "successful_logins", "file_downloads", *TECHNIQUES)
    return joined.select("day", *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in columns])


def timeline_daily(spark: SparkSession, path: str, now: datetime, window: str = "7d") -> DataFrame:
    span = _days(now, max(1, reports.HOURS[window] // 24))
    totals = hours(spark, path).read(between=span).filter(F.col("dimension") == "eventid").groupBy("day").agg(F.sum("count").alias("total_events"))
    return reports.timeline_daily(totals, now, window)


def summary_card(spark: SparkSession, path: str, now: datetime) -> DataFrame:
    """The front page's totals in the reference mode: today's counts, and when a sensor was seen last."""
    today = daily_summaries(spark, path, between=(now.date().isoformat(), now.date().isoformat()))
    seen = sightings(spark, path).read().agg(F.max("ts").alias("sensor_last_seen"))
    zero = F.lit(0).cast("bigint")
    counted = today.agg(F.coalesce(F.sum("total_events"), zero).alias("total"), F.coalesce(F.sum("unique_ips"), zero).alias("unique_ips_24h"))
    both = counted.unionByName(seen, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in ("total", "unique_ips_24h", "sensor_last_seen")])
    return both.select("total", F.col("total").alias("last_24h"), zero.alias("last_1h"), "unique_ips_24h", "sensor_last_seen")
