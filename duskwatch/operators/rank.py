"""Rankings and dedup. ``row_number() <= k`` is cut on the map side by Spark's window group limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.operators.rollup import RANKED_DIMENSIONS

TOP_N = 25
RANK_CEILING = 9_999_999_999


def top_ranks(totals: DataFrame, n: int = TOP_N) -> DataFrame:
    """The first ``n`` values per window and dimension: count descending, then value ascending."""
    order = Window.partitionBy("window", "dimension").orderBy(F.desc("count"), F.asc("value"))
    return (
        totals.filter(F.col("dimension").isin(*RANKED_DIMENSIONS))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
    )


def rank_key(count: Column, value: Column) -> Column:
    """Text that sorts ascending as count descending, value ascending."""
    return F.concat(
        F.lpad((F.lit(RANK_CEILING) - count).cast("string"), 10, "0"), F.lit("#"), value
    )


def last_write_wins(events: DataFrame, arrival: str) -> DataFrame:
    """Newest arrival of each (session, ts, eventid)."""
    order = Window.partitionBy("session", "ts", "eventid").orderBy(F.desc(arrival))
    return events.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")


def relative_intensity(ranked: DataFrame, codes: DataFrame) -> DataFrame:
    """Map feed: ranked countries with numeric code, name and count relative to the maximum.

    ``ranked`` is one ranking of at most a few dozen rows; unmapped countries are dropped.
    """
    mapped = ranked.join(codes, F.upper(ranked["value"]) == codes["alpha2"]).select(
        "numeric", "name", "alpha2", "count"
    )
    everything = Window.partitionBy(F.lit(0))
    return (
        mapped.withColumn("max_count", F.max("count").over(everything))
        .withColumn("countries", F.count(F.lit(1)).over(everything))
        .withColumn("intensity", F.round(F.col("count") / F.col("max_count"), 6))
    )
