"""Streaming dedup, change-feed decoding, hourly counters, session summaries and scheduled rebuilds."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.operators.rank import top_ranks
from duskwatch.operators.joins import lookup_left
from duskwatch.operators.rollup import (
    CLOSED,
    COMMAND,
    FAILED,
    SUCCESS,
    all_counters,
    command_column,
    daily_summary,
    dimension_columns,
    proxy_port_column,
    technique_hourly,
    trailing_totals,
)
from duskwatch.operators.validate import compute_once
from duskwatch.schemas import CHANGE_RECORD
from duskwatch.session import stage
from duskwatch.sources.store import AppendTable, newest, path_exists, summed
from duskwatch.streaming.run import drain_batches


def dedup_stream(stream: DataFrame, key: str, event_time: str, horizon: str = "1 hour") -> DataFrame:
    """Drop repeats of ``key`` seen within the horizon; rows without a key pass through."""
    marked = stream.withWatermark(event_time, horizon)
    keyed = marked.filter(F.col(key).isNotNull()).dropDuplicatesWithinWatermark([key])
    return keyed.unionByName(marked.filter(F.col(key).isNull()))


def _scalar(attribute: Column) -> Column:
    return F.coalesce(attribute["S"], attribute["N"], attribute["BOOL"].cast("string"))


def attribute_text(image: Column, name: str) -> Column:
    """A typed attribute as text; lists and maps become JSON, NULL becomes null."""
    a = image[name]
    listed = F.to_json(F.transform(a["L"], _scalar))
    mapped = F.to_json(F.transform_values(a["M"], lambda _, v: _scalar(v)))
    return F.coalesce(_scalar(a), listed, mapped)


def decode_changes(lines: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Change records as typed columns with an ``outcome``.

    Only inserts and updates with an image of an event are ``processed``; removals and
    records without an image are ``skipped``, other item types ``skipped_non_event``.
    """
    record = compute_once(lines, r=F.from_json("line", CHANGE_RECORD))
    image = F.col("r.dynamodb.NewImage")
    usable = F.coalesce(F.col("r.eventName").isin("INSERT", "MODIFY"), F.lit(False)) & (
        F.coalesce(F.size(image), F.lit(0)) > 0
    )
    event = F.coalesce(attribute_text(image, "type") == "EVENT", F.lit(False))
    return record.select(
        F.col("r.eventID").alias("change_id"),
        F.when(~usable, "skipped").when(~event, "skipped_non_event").otherwise("processed").alias("outcome"),
        *[attribute_text(image, name).try_cast(kind).alias(name) for name, kind in fields.items()],
    )


def counted_columns(columns: list[str]) -> dict[str, Column]:
    """The dimensions that can be counted event by event: the plain fields, command and proxy port where the columns are there."""
    found = dict(dimension_columns())
    if "input" in columns:
        found["command"] = command_column()
    if "dst_port" in columns:
        found["proxy_target_port"] = proxy_port_column()
    return found


COUNTER = ("bucket", "dimension", "value", "day")


def counter_table(spark: SparkSession, path: str) -> AppendTable:
    """Counts per hour, dimension and value by day: each batch appends its own, readers add them up."""
    return AppendTable(spark, path, "day", summed(COUNTER, ("count",)))


def technique_table(spark: SparkSession, path: str) -> AppendTable:
    """The counts of the technique dimension, which are replaced and not added to."""
    return AppendTable(spark, f"{path}/technique", "day", newest(COUNTER))


def stored_counters(spark: SparkSession, path: str, *, between: tuple[str, str] | None = None) -> DataFrame:
    """(bucket, dimension, value, day, count) of all dimensions, of a range of days only where one is given."""
    tables = [t for t in (counter_table(spark, path), technique_table(spark, path)) if t.exists()]
    if not tables:
        raise FileNotFoundError(f"no counters at {path}")
    return reduce(DataFrame.unionByName, [t.read(between=between).select(*COUNTER, "count") for t in tables])


def counts_of(batch: DataFrame) -> DataFrame:
    """Counts per hour of ``event_time``, dimension and value."""
    pairs = F.array_compact(
        F.array(
            *[
                F.when(v.isNotNull(), F.struct(F.lit(n).alias("dimension"), v.cast("string").alias("value")))
                for n, v in counted_columns(batch.columns).items()
            ]
        )
    )
    return (
        batch.filter(F.col("event_time").isNotNull())
        .select(F.date_format("event_time", "yyyy-MM-dd'T'HH").alias("bucket"), F.explode(pairs).alias("p"))
        .groupBy("bucket", F.col("p.dimension").alias("dimension"), F.col("p.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("day", F.substring("bucket", 1, 10))
    )


def maintain_hourly_counts(stream: DataFrame, path: str, checkpoint: str, lateness: str = "1 hour", fold: int = 8) -> None:
    """Keep the counter table up to date, rows of any lateness included.

    A batch appends its counts as new files, once however often it is repeated, and days with more than ``fold`` batches
    are folded into one. What came for an hour closed ``lateness`` after its end is counted as the rest, and listed
    besides in ``late_counts``.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        table = counter_table(batch.sparkSession, path)
        before = table.manifest()
        if batch_id <= before.applied:
            return
        counts = stage(counts_of(batch), "batch-counts")
        latest = counts.agg(F.max("bucket")).first()[0]
        if before.note is not None:
            hour = "yyyy-MM-dd'T'HH"
            closed = F.to_timestamp("bucket", hour) + F.expr(f"INTERVAL 1 hour + INTERVAL {lateness}")
            late = counts.filter(closed <= F.to_timestamp(F.lit(before.note), hour)).select("bucket", "dimension", "value", "count")
            if not late.isEmpty():
                late.write.mode("overwrite").parquet(f"{checkpoint}/late/batch={batch_id}")
        table.append(counts, batch_id, note=max(filter(None, (before.note, latest)), default=None))
        table.compact(fold)

    drain_batches(stream, on_batch, checkpoint)


def late_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(bucket, dimension, value, count, batch) of what ``maintain_hourly_counts`` added to closed hours."""
    schema, path = "bucket string, dimension string, value string, count bigint, batch bigint", f"{checkpoint}/late"
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


SESSIONS = (
    "session string, ts string, duration_seconds double, login_failed_count bigint, login_success_count bigint, "
    "unique_usernames bigint, command_count bigint"
)
SESSION_KEY = ("session", "username", "ts", "duration_seconds", "slot")
SESSION_SUMS = ("failed", "succeeded", "commands", "closings", "events")
SESSION_SLOTS = 32


def session_table(spark: SparkSession, path: str) -> AppendTable:
    """The mergeable state of sessions, by hash of the session: sums per login name, and closings with their number."""
    return AppendTable(spark, path, "slot", summed(SESSION_KEY, SESSION_SUMS), ("session",), ("session",))


def session_parts(events: DataFrame) -> DataFrame:
    """What some events add to the state of their sessions; adding up parts in any order gives the whole."""
    eid = F.col("eventid")
    closed, login = eid == CLOSED, eid.isin(FAILED, SUCCESS)
    return (
        events.filter(F.col("session") != "")
        .groupBy(
            "session",
            F.when(login, F.col("username")).alias("username"),
            F.when(closed, F.col("ts")).alias("ts"),
            F.when(closed, F.coalesce(F.col("duration"), F.lit(0.0))).alias("duration_seconds"),
        )
        .agg(
            F.count_if(eid == FAILED).alias("failed"),
            F.count_if(eid == SUCCESS).alias("succeeded"),
            F.count_if(eid == COMMAND).alias("commands"),
            F.count_if(closed).alias("closings"),
            F.count(F.lit(1)).alias("events"),
        )
        .withColumn("slot", F.pmod(F.xxhash64("session"), F.lit(SESSION_SLOTS)).cast("string"))
    )


def summaries_of(parts: DataFrame) -> DataFrame:
    """One row per closing with the counters of the whole session, from the merged state."""
    totals = parts.groupBy("session").agg(
        F.sum("failed").alias("login_failed_count"),
        F.sum("succeeded").alias("login_success_count"),
        F.count_distinct("username").alias("unique_usernames"),
        F.sum("commands").alias("command_count"),
        F.sum("events").alias("event_count"),
    )
    closed = parts.filter("closings > 0").select("session", "ts", "duration_seconds", F.explode(F.sequence(F.lit(1).cast("bigint"), "closings")).alias("__i"))
    found = lookup_left(closed, totals, "session", spread_by=["ts", "__i"], rows_per_key="event_count")
    return found.select(*[c.split()[0] for c in SESSIONS.split(", ")])


def session_summary(spark: SparkSession, path: str, sessions: list[str] | None = None) -> DataFrame:
    """The summaries as of now; of some sessions only, from the files that hold their state."""
    table = session_table(spark, path)
    return summaries_of(table.read() if sessions is None else table.rows_of("session", sessions))


def maintain_session_summaries(stream: DataFrame, path: str, checkpoint: str, fold: int = 8) -> None:
    """Fold each batch into the state of its sessions, which ``session_summary`` reads.

    Only the batch is read: its sums and login names are appended once, however often it is repeated, and hash slots with
    more than ``fold`` batches are folded into one. Nothing expires, so events of any order and lateness count.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        table = session_table(batch.sparkSession, path)
        table.append(session_parts(batch), batch_id)
        table.compact(fold)

    drain_batches(stream, on_batch, checkpoint)


def refresh_technique_counts(events: DataFrame, path: str, history: DataFrame | None = None) -> None:
    """Count the closings of stored ``events`` by technique into the counter table.

    A label needs the whole session, so it is taken from the store and not from state that may have expired; hours are
    replaced, so repeats are harmless.
    """
    counts = technique_hourly(events, history).withColumn("day", F.substring("bucket", 1, 10))
    table = technique_table(events.sparkSession, path)
    table.append(counts, table.manifest().applied + 1)


def rebuild_ranks(spark: SparkSession, counters: str, out: str, now: datetime) -> None:
    """Replace the rankings from the counter table alone; only the days of the window are read."""
    first = datetime.fromordinal(now.toordinal() - 7).strftime("%Y-%m-%d")
    recent = stored_counters(spark, counters, between=(first, now.strftime("%Y-%m-%d")))
    top_ranks(trailing_totals(recent, now)).write.mode("overwrite").parquet(out)


def rebuild_summary(events: DataFrame, out: str, day: str) -> None:
    """Replace one day's summary row."""
    summary = daily_summary(events, technique_hourly(events), day=day)
    (
        summary.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(out)
    )


def write_counters(events: DataFrame, path: str) -> None:
    """All counters as a table partitioned by day."""
    (
        all_counters(events)
        .withColumn("day", F.substring("bucket", 1, 10))
        .hint("rebalance", F.col("day"))
        .write.mode("overwrite")
        .partitionBy("day")
        .parquet(path)
    )
