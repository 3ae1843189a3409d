"""Rolling counts of a stream: rows are appended by time chunk, and closed chunks are swept as a batch.

A chunk is as long as the interval. It is swept once the newest row is ``delay_us`` past its end, together with the chunk
before it, which its intervals reach into. Rows that come for a chunk swept already change its counts and those of the
next one, so both are swept again and replaced. There is no state per key: Spark sorts and spills, and a hot source is
spread as in ``operators.sweep``. A repeated micro-batch changes nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.functions.timefns import floor_div
from duskwatch.operators.sweep import self_counts
from duskwatch.session import stage
from duskwatch.sources.store import AppendTable
from duskwatch.streaming.run import drain_batches

OFFSET = 10**11  # makes chunk numbers texts of equal length, also before 1970


def chunk_text(ts_us: Column, width_us: int) -> Column:
    return (floor_div(ts_us, width_us) + F.lit(OFFSET)).cast("string")


def row_table(spark: SparkSession, path: str) -> AppendTable:
    return AppendTable(spark, f"{path}/rows", "chunk", lambda rows: rows.drop("batch"))


def count_table(spark: SparkSession, path: str) -> AppendTable:
    """Each chunk's counts, replaced as a whole."""
    return AppendTable(spark, f"{path}/counts", "chunk", lambda rows: rows.drop("batch"))


def rolling_counts(spark: SparkSession, path: str) -> DataFrame:
    return count_table(spark, path).read().drop("chunk")


def sweep_chunks(table: AppendTable, chunks: set[int], *, key: str, value: str | None, width_us: int, keep: str) -> DataFrame:
    """The counts of some chunks' rows; only these chunks and those before them are read."""
    read = table.read([str(c + OFFSET) for c in chunks | {c - 1 for c in chunks}])
    counted = self_counts(read, key=key, value=value, hi=width_us)
    return counted.filter(F.col("chunk").isin([str(c + OFFSET) for c in chunks])).filter(keep)


def maintain_rolling_counts(
    stream: DataFrame, path: str, checkpoint: str, *, width_us: int, key: str = "src_ip", value: str | None = "username", delay_us: int = 0, keep: str = "true", fold: int = 8
) -> None:
    """Keep ``n_events`` and ``n_distinct`` over ``[t - width_us, t]`` of a row's key, for rows that pass ``keep``.

    Needs ``ts_us``; other columns are carried along.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows, counts = row_table(spark, path), count_table(spark, path)
        before = counts.manifest()
        if batch_id <= before.applied:
            return
        timed = stage(batch.filter(F.col("ts_us").isNotNull()).withColumn("chunk", chunk_text(F.col("ts_us"), width_us)), "rolling-rows")
        rows.append(timed, batch_id)
        rows.compact(fold)
        arrived = {int(r[0]) - OFFSET for r in timed.select("chunk").distinct().collect()}  # one row a chunk
        newest, done = json.loads(before.note) if before.note else (None, None)
        latest = timed.agg(F.max("ts_us")).first()[0]
        newest = max((t for t in (newest, latest) if t is not None), default=None)
        if newest is None:
            return
        closed = (newest - delay_us) // width_us - 1
        known = {int(p) - OFFSET for _, p in rows.manifest().live}
        fresh = {c for c in known if c <= closed and (done is None or c > done)}
        late = {d for c in arrived if done is not None and c <= done for d in (c, c + 1) if d <= closed} & known
        chunks = fresh | late
        note = json.dumps([newest, closed if done is None else max(closed, done)])
        result = sweep_chunks(rows, chunks, key=key, value=value, width_us=width_us, keep=keep)
        counts.append(result, batch_id, note=note, replace=[str(c + OFFSET) for c in chunks])

    drain_batches(stream, on_batch, checkpoint)
