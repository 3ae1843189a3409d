"""Trailing-interval counts by sweeping over time instead of pairing rows.

A point at time p is "open" for probes in ``[p + lo, p + hi]``. Each point becomes a +1 at
the opening and a -1 after the closing; the running sum at a probe is its number of
points. Work is n log n however many points an interval holds. Time is cut into chunks
and a point is repeated in each chunk its interval touches, so one hot key is spread over
as many tasks as it has chunks, and equal points are merged before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.functions.timefns import DAY_US, floor_div


def trailing_counts(
    points: DataFrame,
    probes: DataFrame,
    *,
    keys: Sequence[str] = (),
    time: str = "ts_us",
    lo: int = 0,
    hi: int,
    carry: str | None = None,
    weight: str | None = None,
    chunk: int | None = None,
    count_as: str = "n_points",
) -> DataFrame:
    """Add to each probe the number of points in ``[t - hi, t - lo]`` with equal keys.

    With ``carry`` the probe also gets ``last_<carry>``, the value of the newest such point
    (the lowest value among points of one instant). With ``weight`` a point counts as many times.
    """
    size = chunk or 2 * (hi - lo + 1)
    base = points.select(*keys, F.col(time), *([carry] if carry else []), *([weight] if weight else []))
    aggs = [(F.sum(weight) if weight else F.count(F.lit(1))).alias("__n")] + ([F.min(carry).alias("__carry")] if carry else [])
    merged = base.groupBy(*keys, time).agg(*aggs)
    opening, closing = F.col(time) + F.lit(lo), F.col(time) + F.lit(hi + 1)
    deltas = (
        merged.withColumn(
            "__chunk", F.explode(F.sequence(floor_div(opening, size), floor_div(closing - 1, size)))
        )
        .withColumn(
            "__ends",
            F.explode(
                F.array(
                    F.struct(opening.alias("t"), F.col("__n").alias("d"), F.lit(True).alias("open")),
                    F.struct(closing.alias("t"), (-F.col("__n")).alias("d"), F.lit(False).alias("open")),
                )
            ),
        )
        .select(
            *keys,
            "__chunk",
            F.col("__ends.t").alias("__t"),
            F.col("__ends.d").alias("__d"),
            *([F.when(F.col("__ends.open"), F.col("__carry")).alias("__carry")] if carry else []),
        )
    )
    asked = (
        probes.withColumn("__t", F.col(time))
        .withColumn("__chunk", floor_div(F.col(time), size))
        .withColumn("__d", F.lit(0).cast("bigint"))
        .withColumn("__probe", F.lit(True))
    )
    window = (
        Window.partitionBy(*keys, "__chunk")
        .orderBy("__t")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    swept = asked.unionByName(deltas, allowMissingColumns=True).withColumn(count_as, F.sum("__d").over(window))
    extra = []
    if carry:
        swept = swept.withColumn(f"last_{carry}", F.last("__carry", ignorenulls=True).over(window))
        extra = [F.when(F.col(count_as) > 0, F.col(f"last_{carry}")).alias(f"last_{carry}")]
    return swept.filter("__probe").select(*probes.columns, count_as, *extra)


def self_counts(
    rows: DataFrame, *, key: str, value: str | None = None, time: str = "ts_us", hi: int, chunk: int | None = None
) -> DataFrame:
    """Add ``n_events``, and with ``value`` also ``n_distinct``, over ``[t - hi, t]`` of the row's own key.

    One scan and one shuffle: a row is sent to its own chunk and, where its interval
    reaches further, to the next one. A distinct value is counted from one occurrence
    until its next one or until it leaves the interval, whichever is first, so distinct
    counts are running sums as well.
    """
    size = chunk or 2 * (hi + 1)
    t, closing = F.col(time), F.col(time) + F.lit(hi + 1)
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    own = floor_div(t, size)
    placed = rows.withColumn(
        "__chunk", F.explode(F.sequence(own, floor_div(t + F.lit(hi), size)))
    ).repartition(key, "__chunk")
    placed = placed.withColumn("__own", F.col("__chunk") == own)
    if value is None:
        unit, end = zero, closing
    else:
        unit = F.when(F.col(value).isNotNull(), one).otherwise(zero)
        following = F.lead(time).over(Window.partitionBy(key, "__chunk", value).orderBy(time))
        end = F.least(F.coalesce(following, closing), closing)
    placed = placed.withColumn("__unit", unit).withColumn("__end", end)

    def delta(at, d, u, probe):
        return F.struct(at.alias("t"), d.alias("d"), u.alias("u"), probe.alias("probe"))

    steps = [
        delta(t, one, F.col("__unit"), F.col("__own")),
        delta(closing, -one, zero, F.lit(False)),
    ]
    if value is not None:
        steps.append(delta(F.col("__end"), zero, -F.col("__unit"), F.lit(False)))
    payload = [c for c in rows.columns if c != key]
    stepped = placed.withColumn("__s", F.explode(F.array(*steps))).select(
        key,
        "__chunk",
        F.col("__s.t").alias("__t"),
        F.col("__s.d").alias("__d"),
        F.col("__s.u").alias("__u"),
        F.col("__s.probe").alias("__probe"),
        *[F.when(F.col("__s.probe"), F.col(c)).alias(c) for c in payload],
    )
    window = (
        Window.partitionBy(key, "__chunk").orderBy("__t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = stepped.withColumn("n_events", F.sum("__d").over(window))
    names = ["n_events"]
    if value is not None:
        out = out.withColumn("n_distinct", F.sum("__u").over(window))
        names.append("n_distinct")
    return out.filter("__probe").select(*rows.columns, *names)


def single_owner(
    points: DataFrame, probes: DataFrame, *, owner: str, time: str = "ts_us", lo: int, hi: int
) -> DataFrame:
    """For each probe instant p: does ``[p + lo, p + hi]`` hold points of exactly one owner?

    Points are sorted by (time, owner) and cut into runs of one owner. An interval with
    points has one owner when the run of its last point began at or before its first
    point, so two positions per probe decide it and no pair is formed.
    ``owners`` is 0, 1 or 2 (2 = several); ``owner`` is set when it is 1.
    """
    size = max(hi - lo + 1, 1)
    merged = points.select(F.col(time).alias("__t"), F.col(owner).alias("__owner")).distinct()
    placed = merged.withColumn(
        "__chunk",
        F.explode(F.sequence(floor_div(F.col("__t") - F.lit(hi - lo), size), floor_div(F.col("__t"), size))),
    ).withColumn("__kind", F.lit(1))
    asked = (
        probes.select(F.col(time).alias("__probe")).distinct()
        .withColumn("__chunk", floor_div(F.col("__probe") + F.lit(lo), size))
        .withColumn(
            "__at",
            F.explode(
                F.array(
                    F.struct((F.col("__probe") + F.lit(lo)).alias("t"), F.lit(0).alias("kind")),
                    F.struct((F.col("__probe") + F.lit(hi)).alias("t"), F.lit(2).alias("kind")),
                )
            ),
        )
        .select("__probe", "__chunk", F.col("__at.t").alias("__t"), F.col("__at.kind").alias("__kind"))
    )
    order = Window.partitionBy("__chunk").orderBy("__t", "__kind", "__owner")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_point = F.col("__kind") == 1
    swept = (
        placed.unionByName(asked, allowMissingColumns=True)
        .withColumn("__previous", F.last(F.when(is_point, F.col("__owner")), ignorenulls=True).over(before))
        .withColumn("__seen", F.sum(F.when(is_point, 1).otherwise(0)).over(upto))
        .withColumn(
            "__run_at",
            F.when(
                is_point & (F.col("__previous").isNull() | (F.col("__previous") != F.col("__owner"))),
                F.col("__seen"),
            ),
        )
        .withColumn("__run_at", F.last("__run_at", ignorenulls=True).over(upto))
        .withColumn("__last", F.last(F.when(is_point, F.col("__owner")), ignorenulls=True).over(upto))
        .filter(~is_point)
    )
    low, high = F.col("__kind") == 0, F.col("__kind") == 2
    return (
        swept.groupBy(F.col("__probe").alias(time))
        .agg(
            F.max(F.when(low, F.col("__seen"))).alias("a"),
            F.max(F.when(high, F.col("__seen"))).alias("b"),
            F.max(F.when(high, F.col("__run_at"))).alias("r"),
            F.max(F.when(high, F.col("__last"))).alias("o"),
        )
        .withColumn(
            "owners", F.when(F.col("b") <= F.col("a"), 0).when(F.col("r") <= F.col("a") + 1, 1).otherwise(2)
        )
        .select(time, "owners", F.when(F.col("owners") == 1, F.col("o")).alias(owner))
    )


def nearest_preceding(
    probes: DataFrame, points: DataFrame, *, time: str = "ts_us", floor_us: int = 0, chunk: int = 60_000_000
) -> DataFrame:
    """Add ``point_us``, the newest point at or before ``t - floor_us`` (null when there is none).

    Each chunk of time is swept on its own; the newest point of earlier chunks is carried
    over within each day, and over days through a table of one row per day.
    """
    shifted = points.select((F.col(time) + F.lit(floor_us)).alias("__t")).distinct()
    marks = shifted.withColumn("__chunk", floor_div(F.col("__t"), chunk)).withColumn("__mark", F.col("__t"))
    asked = (
        probes.withColumn("__t", F.col(time))
        .withColumn("__chunk", floor_div(F.col(time), chunk))
        .withColumn("__probe", F.lit(True))
    )
    window = (
        Window.partitionBy("__chunk").orderBy("__t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    swept = (
        asked.unionByName(marks, allowMissingColumns=True)
        .withColumn("__here", F.max("__mark").over(window))
        .filter("__probe")
    )
    # A day's newest point is carried over days, one row each; within its day a chunk looks at earlier chunks.
    day = floor_div(F.col("__chunk"), max(DAY_US // chunk, 1))
    per_chunk = asked.select("__chunk").distinct().join(
        marks.groupBy("__chunk").agg(F.max("__mark").alias("__max")), "__chunk", "full"
    ).withColumn("__day", day)
    per_day = per_chunk.groupBy("__day").agg(F.max("__max").alias("__max"))
    before = Window.orderBy("__day").rowsBetween(Window.unboundedPreceding, -1)
    of_days = per_day.select("__day", F.max("__max").over(before).alias("__earlier"))
    inside = Window.partitionBy("__day").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_chunk.withColumn("__same_day", F.max("__max").over(inside)).join(of_days, "__day").select(
        F.col("__chunk").alias("__carry_chunk"), F.coalesce("__same_day", "__earlier").alias("__carried")
    )
    return swept.join(carried, swept["__chunk"] == carried["__carry_chunk"], "left").select(
        *probes.columns, (F.coalesce("__here", "__carried") - F.lit(floor_us)).alias("point_us")
    )
