"""End-to-end ingest: events and proxy rows from one landing folder into a store of resolved events.

Objects are routed by path. A batch's proxy rows are stored; its events are matched forward against all stored proxy rows
and take over matches of their sessions from the store and the batch; geo data follows the new address. Then the batch's
proxy rows are matched backward to events that were stored before. So the logs may arrive in either order. Of the store
only the days around the batch's proxy rows and the files of the sessions in question are read, and each step appends
under the batch's number, so a repeated batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.functions.net import LOOPBACK
from duskwatch.functions.timefns import day_key
from duskwatch.operators.correlate import FLOOR_US, WINDOW_US, correlate_backward, correlate_forward, inherit_matches
from duskwatch.operators.enrich import classify_passwords, geo_enrich
from duskwatch.operators.validate import conform, split_events, strip_transport
from duskwatch.session import stage
from duskwatch.sources.logs import PROXY_COLUMNS, parse_events, parse_proxy, read_lines, source_kind
from duskwatch.sources.sinks import sink_events
from duskwatch.sources.store import AppendTable, event_store, newest
from duskwatch.streaming.run import drain_batches


def _days(frame: DataFrame, before_us: int, after_us: int) -> tuple[str, str]:
    """The days that rows within these distances of the frame's rows can be on."""
    text = lambda c: F.date_format(F.timestamp_micros(c), "yyyy-MM-dd")
    return tuple(frame.agg(text(F.min("ts_us") - before_us), text(F.max("ts_us") + after_us)).first())


def proxy_store(spark: SparkSession, path: str) -> AppendTable:
    return AppendTable(spark, path, "day", newest(("ts", "client_ip", "client_port")), sort=("ts",))


def open_sessions(store: AppendTable, days: tuple[str, str]) -> DataFrame:
    """All stored rows of the sessions with an event on these days that has no address of its own yet."""
    near = store.read(between=days).filter(F.col("src_ip") == LOOPBACK).select("session").distinct()
    return store.rows_of("session", stage(near, "open-sessions"))


def resolve_batch(
    lines: DataFrame,
    batch_id: int,
    *,
    geo_ranges: DataFrame,
    dictionary: DataFrame,
    store: str,
    proxies: str,
    quarantine: str,
    window_us: int = WINDOW_US,
    floor_us: int = FLOOR_US,
) -> None:
    spark = lines.sparkSession
    span = {"window_us": window_us, "floor_us": floor_us}
    kind = source_kind(F.col("object_path"))
    arrived = stage(parse_proxy(lines.filter(kind == "proxy")).filter("parsed").select(*PROXY_COLUMNS), "proxies")
    good, bad = split_events(parse_events(lines.filter(kind == "event")))
    typed = stage(conform(strip_transport(good)), "typed-events")
    events_, proxies_ = event_store(spark, store), proxy_store(spark, proxies)
    if not arrived.isEmpty():
        once = arrived.dropDuplicates(["ts", "client_ip", "client_port"])
        proxies_.append(once.withColumn("day", day_key(F.col("ts"))), batch_id)
        if events_.exists():
            # a matched session's open events take the address wherever they are in the store
            # read by each step of the backward pass, so the lookup and its merge are done once
            before = stage(open_sessions(events_, _days(arrived, 0, window_us)).withColumn("__was", F.col("correlation_status")), "open-events")
            after = correlate_backward(before, arrived, geo_ranges=geo_ranges, **span)
            open_before = F.col("__was").isNull() | F.col("__was").isin("missed", "ambiguous")
            changed = stage(after.filter(open_before & (F.col("correlation_status") == "matched")).drop("__was"), "back-matched")
            events_.append(changed, 2 * batch_id)
    if not typed.isEmpty():
        if proxies_.exists():
            known = proxies_.read(between=_days(typed, window_us, 0)).select("ts_us", "client_ip")
        else:
            known = spark.createDataFrame([], "ts_us bigint, client_ip string")
        forward = stage(correlate_forward(typed, known, **span).withColumn("__fresh", F.lit(True)), "forward")
        together = forward
        if events_.exists():
            earlier = events_.rows_of("session", forward).withColumn("__fresh", F.lit(False))
            together = forward.unionByName(earlier.drop("day", "country", "asn", "asn_org", "password_raw"), allowMissingColumns=True)
        resolved = inherit_matches(stage(together, "together")).filter("__fresh").drop("__fresh")
        sink_events(classify_passwords(geo_enrich(resolved, geo_ranges), dictionary), store, batch=2 * batch_id + 1)
    (
        bad.select("line", "object_path", "eventid", "failed_rules", F.lit(batch_id).alias("batch_id"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(quarantine)
    )


def ingest_resolved(spark: SparkSession, raw: str, *, checkpoint: str, **options) -> None:
    """Resolve the objects below ``raw`` that are new since the last run, each once."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        resolve_batch(batch, batch_id, **options)

    drain_batches(read_lines(spark, raw, streaming=True), on_batch, checkpoint)
