"""Incremental ingest of landed event objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.operators.enrich import classify_passwords, geo_enrich
from duskwatch.operators.validate import conform, split_events, strip_transport
from duskwatch.sources.logs import parse_events, read_lines
from duskwatch.sources.sinks import sink_events
from duskwatch.streaming.run import drain_batches


def store_and_quarantine(
    batch: DataFrame, batch_id: int, *, geo_ranges: DataFrame, dictionary: DataFrame, store: str, quarantine: str
) -> None:
    """Good events into the event store, bad lines with their reasons into the quarantine.

    A repeated batch changes nothing: the store knows its batches, the quarantine is
    partitioned by batch.
    """
    good, bad = split_events(parse_events(batch))
    typed = conform(strip_transport(good))
    sink_events(classify_passwords(geo_enrich(typed, geo_ranges), dictionary), store, batch=batch_id)
    (
        bad.select("line", "object_path", "eventid", "failed_rules", F.lit(batch_id).alias("batch_id"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(quarantine)
    )


def ingest_events(
    spark: SparkSession,
    raw: str,
    *,
    geo_ranges: DataFrame,
    dictionary: DataFrame,
    store: str,
    quarantine: str,
    checkpoint: str,
) -> None:
    """Ingest the objects that are new since the last run, each once."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        store_and_quarantine(
            batch, batch_id, geo_ranges=geo_ranges, dictionary=dictionary, store=store, quarantine=quarantine
        )

    drain_batches(read_lines(spark, raw, streaming=True), on_batch, checkpoint)
