"""Inheritance of a session's first matched address, kept in tables instead of stream state.

A batch appends its events by day, and for each of its sessions one row with the earliest match and the number of rows.
Readers merge a session's rows to its first match so far and give that address to the later events, so the result does
not depend on the order of arrival, nothing is forgotten however long a session lasts, and an earlier match that comes
late corrects what was read before. A repeated micro-batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.functions.timefns import DAY_US, floor_div
from duskwatch.operators.joins import lookup_left
from duskwatch.session import stage
from duskwatch.sources.store import AppendTable, key_hash, slot_of
from duskwatch.streaming.run import drain_batches


def arrived_table(spark: SparkSession, path: str) -> AppendTable:
    return AppendTable(spark, f"{path}/arrived", "day", lambda rows: rows.drop("batch"), ("session",), ("session",))


def first_table(spark: SparkSession, path: str) -> AppendTable:
    """Each session's earliest match and number of rows."""

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy("slot", "session").agg(F.min("first").alias("first"), F.sum("n").alias("n"))

    return AppendTable(spark, f"{path}/firsts", "slot", merge, ("session",), ("session",))


def position():
    """Order of a session's events: time, event type, id; missing ones come first."""
    return F.struct("ts_us", F.coalesce("eventid", F.lit("")).alias("eventid"), F.coalesce("event_id", F.lit(-1)).alias("event_id"))


def take_first(rows: DataFrame, firsts: DataFrame, **hot: int) -> DataFrame:
    """Events with a status that come after their session's first match take its address."""
    known = firsts.filter(F.col("first").isNotNull()).select("session", "n", F.col("first").alias("__first"))
    joined = lookup_left(rows, known, "session", spread_by=["ts_us", "event_id"], rows_per_key="n", **hot)
    later = F.coalesce(F.col("status").isNotNull() & (position() > F.col("__first.at")), F.lit(False))
    return (
        joined.withColumn("src_ip", F.when(later, F.col("__first.src_ip")).otherwise(F.col("src_ip")))
        .withColumn("status", F.when(later, "matched_inherited").otherwise(F.col("status")))
        .drop("__first")
    )


def inherited(spark: SparkSession, path: str, *, between: tuple[str, str] | None = None) -> DataFrame:
    """All events, or those of some days (``YYYY-MM-DD``, both included)."""
    return take_first(arrived_table(spark, path).read(between=between), first_table(spark, path).read()).drop("day")


def inherited_of(spark: SparkSession, path: str, sessions: Sequence[str]) -> DataFrame:
    """The events of some sessions; only files that hold rows of them are opened."""
    rows = arrived_table(spark, path).rows_of("session", sessions)
    return take_first(rows, first_table(spark, path).rows_of("session", sessions)).drop("day")


def maintain_inheritance(stream: DataFrame, path: str, checkpoint: str, *, fold: int = 8) -> None:
    """Append ``event_id, session, ts_us, eventid, src_ip, status`` and each session's first match.

    Events without a session inherit nothing; those without a time are left out.
    """
    columns = ("event_id", "session", "ts_us", "eventid", "src_ip", "status")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        arrived, firsts = arrived_table(spark, path), first_table(spark, path)
        if batch_id <= firsts.manifest().applied:
            return
        day = F.date_format(F.timestamp_micros(floor_div(F.col("ts_us"), DAY_US) * DAY_US), "yyyy-MM-dd")
        rows = stage(batch.select(*columns).filter(F.col("ts_us").isNotNull()).withColumn("day", day), "inherit-rows")
        arrived.append(rows, batch_id)
        match = F.when(F.col("status") == "matched", F.struct(position().alias("at"), "src_ip"))
        per_session = rows.filter(F.col("session").isNotNull()).groupBy("session").agg(
            F.min(match).alias("first"), F.count(F.lit(1)).alias("n")
        )
        firsts.append(per_session.withColumn("slot", slot_of(key_hash(F.col("session"))).cast("string")), batch_id)
        arrived.compact(fold)
        firsts.compact(fold)

    drain_batches(stream, on_batch, checkpoint)
