"""Two-sided correlation of event and proxy streams; either log may arrive first, and late rows of either correct it.

Both logs are appended by time chunk: tunnelled events as they are, the proxy log as one row per instant (its rows and
least client), so a burst of connections is stored as the instants it has. A chunk is swept once the newest rows of
both logs are ``delay_us`` past its end, together with the proxy instants of the chunk before it, which its windows
reach into. Nothing is paired and no state is held: Spark sorts running sums over the instants. Rows that come for a
chunk swept already have it, and after late proxy rows also the next one, swept again and replaced. A repeated
micro-batch changes nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.functions.net import LOOPBACK
from duskwatch.operators.correlate import FLOOR_US, WINDOW_US
from duskwatch.operators.sweep import trailing_counts
from duskwatch.session import stage
from duskwatch.sources.store import AppendTable
from duskwatch.streaming.rolling import OFFSET, chunk_text
from duskwatch.streaming.run import drain_batches

HOUR_US = 3_600_000_000


def tunnelled_table(spark: SparkSession, path: str) -> AppendTable:
    return AppendTable(spark, f"{path}/tunnelled", "chunk", lambda rows: rows.drop("batch"))


def instant_table(spark: SparkSession, path: str) -> AppendTable:
    """Proxy rows per instant: how many, and the least client."""

    def merge(rows: DataFrame) -> DataFrame:
        return rows.groupBy("chunk", "ts_us").agg(F.sum("n").alias("n"), F.min("client_ip").alias("client_ip"))

    return AppendTable(spark, f"{path}/instants", "chunk", merge)


def outcome_table(spark: SparkSession, path: str) -> AppendTable:
    """Each chunk's outcomes, replaced as a whole."""
    return AppendTable(spark, f"{path}/outcomes", "chunk", lambda rows: rows.drop("batch"))


def correlated(spark: SparkSession, path: str) -> DataFrame:
    """The tunnelled events of closed chunks with ``candidates, status, src_ip``."""
    return outcome_table(spark, path).read().drop("chunk")


def outcomes(events: DataFrame, instants: DataFrame, *, window_us: int, floor_us: int) -> DataFrame:
    """Status, candidate count and address of tunnelled events; instants carry ``ts_us, n, client_ip``."""
    if window_us <= floor_us:
        counted = events.withColumn("candidates", F.lit(0).cast("bigint")).withColumn("__ip", F.lit(None).cast("string"))
    else:
        counts = trailing_counts(
            instants.select("ts_us", "n", "client_ip"), events.select("ts_us").distinct(),
            lo=floor_us, hi=window_us, carry="client_ip", weight="n", count_as="candidates",
        )
        counts = counts.withColumnRenamed("last_client_ip", "__ip").withColumnRenamed("ts_us", "__at")
        counted = events.join(counts, F.col("ts_us") == F.col("__at")).drop("__at")
    n = F.col("candidates")
    return (
        counted.withColumn("status", F.when(n == 0, "missed").when(n == 1, "matched").otherwise("ambiguous"))
        .withColumn("src_ip", F.when(n == 1, F.col("__ip")).otherwise(F.lit(LOOPBACK)))
        .drop("__ip")
    )


def maintain_correlation(
    events: DataFrame,
    proxies: DataFrame,
    path: str,
    checkpoint: str,
    *,
    window_us: int = WINDOW_US,
    floor_us: int = FLOOR_US,
    delay_us: int = 120_000_000,
    chunk_us: int = HOUR_US,
    fold: int = 8,
) -> None:
    """Keep the outcome of each tunnelled event.

    Events carry ``ts_us, src_ip`` (other columns are kept), proxy rows ``ts_us, client_ip``. Rows without a time and
    proxy rows without a client are left out. While one of the logs is silent, nothing new is decided.
    """
    size = max(chunk_us, window_us)
    both = events.withColumn("from_proxy", F.lit(False)).unionByName(
        proxies.select("ts_us", "client_ip", F.lit(True).alias("from_proxy")), allowMissingColumns=True
    )

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tunnelled, instants, found = tunnelled_table(spark, path), instant_table(spark, path), outcome_table(spark, path)
        before = found.manifest()
        if batch_id <= before.applied:
            return
        rows = stage(batch.filter(F.col("ts_us").isNotNull()).withColumn("chunk", chunk_text(F.col("ts_us"), size)), "correlation-rows")
        is_proxy = F.col("from_proxy")
        tunnelled.append(rows.filter(~is_proxy & (F.col("src_ip") == LOOPBACK)).drop("from_proxy", "src_ip", "client_ip"), batch_id)
        merged = rows.filter(is_proxy & F.col("client_ip").isNotNull()).groupBy("chunk", "ts_us")
        instants.append(merged.agg(F.count(F.lit(1)).alias("n"), F.min("client_ip").alias("client_ip")), batch_id)
        tunnelled.compact(fold)
        instants.compact(fold)
        arrived = rows.groupBy(is_proxy, "chunk").agg(F.max("ts_us").alias("newest")).collect()  # two rows a chunk at most
        newest, done = json.loads(before.note) if before.note else ([None, None], None)
        for side in (0, 1):
            times = [r["newest"] for r in arrived if r["from_proxy"] == bool(side)]
            newest[side] = max((t for t in (newest[side], *times) if t is not None), default=None)
        chunks: set[int] = set()
        if None not in newest:
            closed = (min(newest) - delay_us) // size - 1
            known = {int(p) - OFFSET for _, p in tunnelled.manifest().live}
            chunks = {c for c in known if c <= closed and (done is None or c > done)}
            for r in arrived:
                c = int(r["chunk"]) - OFFSET
                if done is not None and c <= done:
                    chunks |= {c, c + 1} & known if r["from_proxy"] else {c} & known
            chunks = {c for c in chunks if c <= closed}
            done = closed if done is None else max(closed, done)
        asked = [str(c + OFFSET) for c in chunks]
        near = [str(c + OFFSET) for c in chunks | {c - 1 for c in chunks}]
        result = outcomes(tunnelled.read(asked), instants.read(near).drop("chunk"), window_us=window_us, floor_us=floor_us)
        found.append(result, batch_id, note=json.dumps([newest, done]), replace=asked)

    drain_batches(both, on_batch, checkpoint)
