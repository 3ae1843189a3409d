"""Join helpers whose plans never fall back to nested loops.

A side is hinted for broadcast only after its rows were counted (``broadcast_if_small``)
or when its size is bounded by construction: of keys with at least ``HOT_ROWS`` rows there
can be only (total rows / HOT_ROWS). Everything else is left to adaptive execution, which
checks sizes itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.functions.net import ip_to_long
from duskwatch.functions.timefns import floor_div

HOT_ROWS = 5_000_000
SPREAD = 256
BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, counted: DataFrame | None = None, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when ``counted`` (default: the frame itself) has at most ``max_rows`` rows.

    The count stops at the limit. Beyond it the join is planned as a shuffle join.
    """
    rows = (df if counted is None else counted).limit(max_rows + 1).count()
    return F.broadcast(df) if rows <= max_rows else df


def lookup_left(
    big: DataFrame,
    lookup: DataFrame,
    key: str,
    *,
    spread_by: Sequence[str],
    rows_per_key: str | None = None,
    hot_rows: int = HOT_ROWS,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Left join to a side with at most one row per ``key``.

    Rows with a null key cannot match; they are spread over partitions by a hash of
    ``spread_by`` instead of meeting in one. When ``lookup`` carries ``rows_per_key`` (the
    number of ``big`` rows of that key, a by-product of the aggregate that built it), keys
    with ``hot_rows`` or more are joined by broadcast and spread the same way, so no task
    gets a whole hot key. With ``broadcast_rows`` the lookup side is counted and broadcast
    when it has no more rows than that.
    """
    values = [c for c in lookup.columns if c not in (key, rows_per_key)]
    if rows_per_key is None:
        cold = lookup
        left = big.withColumn("__key", F.col(key))
        hot_values: dict[str, Column] = {}
    else:
        hot = lookup.filter(F.col(rows_per_key) >= hot_rows).select(
            F.col(key).alias("__hot_key"), *[F.col(c).alias(f"__hot_{c}") for c in values]
        )
        cold = lookup.filter(F.col(rows_per_key) < hot_rows)
        left = big.join(F.broadcast(hot), big[key] == hot["__hot_key"], "left").withColumn(
            "__key", F.when(F.col("__hot_key").isNull(), F.col(key))
        )
        hot_values = {c: F.col(f"__hot_{c}") for c in values}
    # A stand-in key spreads the rows; ``__real`` keeps it from ever matching.
    kind = big.schema[key].dataType
    stand_in = F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)).cast(kind)
    left = left.withColumn("__real", F.col("__key").isNotNull()).withColumn("__key", F.coalesce("__key", stand_in))
    right = cold.select(F.col(key).alias("__right_key"), *[F.col(c).alias(f"__cold_{c}") for c in values])
    if broadcast_rows is not None:
        right = broadcast_if_small(right, lookup, broadcast_rows)
    joined = left.join(
        right,
        (F.col("__key") == F.col("__right_key")) & F.col("__real"),
        "left",
    )
    out = [F.col(c) for c in big.columns if c not in values]
    for c in values:
        cold_value = F.col(f"__cold_{c}")
        out.append((F.coalesce(hot_values[c], cold_value) if c in hot_values else cold_value).alias(c))
    return joined.select(*out)


def interval_join(
    left: DataFrame, right: DataFrame, *, left_time: str, right_time: str, lo: int, hi: int, how: str = "inner"
) -> DataFrame:
    """Pairs with ``right_time`` in ``[left_time - hi, left_time - lo]``.

    Both sides are bucketed by the interval width: the left side is put in the one or two
    buckets its interval touches, so the join is an equi join with a range test on top.
    """
    width = max(hi - lo + 1, 1)
    lb = left.withColumn(
        "__bucket",
        F.explode(
            F.sequence(
                floor_div(F.col(left_time) - F.lit(hi), width), floor_div(F.col(left_time) - F.lit(lo), width)
            )
        ),
    )
    rb = right.withColumn("__rbucket", floor_div(F.col(right_time), width))
    pair = (F.col("__bucket") == F.col("__rbucket")) & F.col(right_time).between(
        F.col(left_time) - F.lit(hi), F.col(left_time) - F.lit(lo)
    )
    return lb.join(rb, pair, how).drop("__bucket", "__rbucket")


def either_endpoint_join(flows: DataFrame, indicators: DataFrame) -> DataFrame:
    """Flows whose source or destination is an indicator value, once per flow and indicator.

    Each flow is unfolded into its endpoints and joined once, so flows are read once and the
    join is an equi join; an OR condition would be a nested loop. A flow between two equal
    listed hosts is kept once per indicator row, with ``src`` as the matched side.

    A flow yields a row per indicator of its ends, so flows are first spread over all shuffle partitions: a scan's
    few tasks would each make the pairs of a large part of the table.
    """
    tasks = int(flows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    flows = flows.repartition(tasks, F.xxhash64(*flows.columns))
    src, dest = F.col("src_ip"), F.col("dest_ip")
    ends = F.array_compact(
        F.array(
            F.struct(src.alias("ip"), F.lit("src").alias("side")),
            F.when(~dest.eqNullSafe(src), F.struct(dest.alias("ip"), F.lit("dest").alias("side"))),
        )
    )
    sides = flows.select("*", F.explode(ends).alias("__end")).select(
        *flows.columns, F.col("__end.ip").alias("__ip"), F.col("__end.side").alias("matched_on")
    )
    ind = indicators.withColumnRenamed("value", "ioc_value")
    return sides.join(ind, sides["__ip"] == ind["ioc_value"]).drop("__ip")


def disjoint_ranges(ranges: DataFrame) -> DataFrame:
    """Split overlapping ``[lo, hi]`` ranges so that each address has one row: its narrowest range.

    Ranges are cut at /16 borders, so every group holds at most 65536 addresses whatever
    the table. Columns other than ``lo`` and ``hi`` are carried along.
    """
    values = [c for c in ranges.columns if c not in ("lo", "hi")]
    cut = (
        ranges.withColumn("span", F.col("hi") - F.col("lo"))
        .withColumn("bucket", F.explode(F.sequence(F.shiftright("lo", 16), F.shiftright("hi", 16))))
        .withColumn("clo", F.greatest(F.col("lo"), F.shiftleft("bucket", 16)))
        .withColumn("chi", F.least(F.col("hi"), F.shiftleft("bucket", 16) + 65535))
    )
    points = cut.select("bucket", F.explode(F.array(F.col("clo"), F.col("chi") + 1)).alias("seg_lo")).distinct()
    segments = points.withColumn(
        "seg_hi", F.lead("seg_lo").over(Window.partitionBy("bucket").orderBy("seg_lo")) - 1
    ).filter(F.col("seg_hi").isNotNull())
    covered = segments.join(cut, "bucket").filter(
        (F.col("clo") <= F.col("seg_lo")) & (F.col("chi") >= F.col("seg_hi"))
    )
    order = F.struct("span", "lo", *values)
    return (
        covered.groupBy("bucket", "seg_lo", "seg_hi")
        .agg(F.min(order).alias("best"))
        .select("bucket", F.col("seg_lo").alias("lo"), F.col("seg_hi").alias("hi"), *[f"best.{c}" for c in values])
    )


def ip_range_join(df: DataFrame, ip: str, ranges: DataFrame) -> DataFrame:
    """Left join each address to its narrowest range; unknown or invalid addresses get nulls.

    The range side is made disjoint first, so the join yields at most one row per input
    row and needs no ranking of the big side. It is an equi join on the top 16 bits.
    """
    # Cutting n ranges gives at most 2 n segments and two per /16 network.
    flat = broadcast_if_small(
        disjoint_ranges(ranges).withColumnsRenamed({"bucket": "__rbucket", "lo": "__lo", "hi": "__hi"}), ranges
    )
    left = df.withColumn("__ip", ip_to_long(F.col(ip)))
    # Addresses without a number get negative buckets: they match nothing and are spread out.
    nowhere = -1 - F.pmod(F.xxhash64(*df.columns[:4]), F.lit(SPREAD))
    left = left.withColumn("__bucket", F.coalesce(F.shiftright("__ip", 16), nowhere))
    cond = (F.col("__bucket") == F.col("__rbucket")) & F.col("__ip").between(F.col("__lo"), F.col("__hi"))
    return left.join(flat, cond, "left").drop("__ip", "__bucket", "__rbucket", "__lo", "__hi")
