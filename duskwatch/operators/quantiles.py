"""Exact nearest-rank quantiles without putting a group's values in order in one task.

Values are counted by bin first, 256 to each doubling, so a group has some ten thousand bins at most. Sums over the bins
give the one that a rank falls into, and only the different values of that bin are counted and put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PER_DOUBLING = 256


def bin_of(value: Column) -> Column:
    """A number that never falls as the value rises."""
    v = value.cast("double")
    return (F.signum(v) * F.floor(F.log2(F.abs(v) + 1) * PER_DOUBLING)).cast("bigint")


def nearest_ranks(rows: DataFrame, groups: Sequence[str], value: str, percents: Sequence[int]) -> DataFrame:
    """(groups, percent, value): the smallest value with at least that share of the group's non-null values up to it."""
    keys = list(groups)
    counted = rows.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    counted = counted.withColumn("__bin", bin_of(F.col("__v")))
    whole = Window.partitionBy(*(keys or [F.lit(0)]))  # over bins, of which there is a bounded number
    bins = counted.groupBy(*keys, "__bin").agg(F.sum("__n").alias("__n"))
    summed = bins.withColumn("__upto", F.sum("__n").over(whole.orderBy("__bin").rowsBetween(Window.unboundedPreceding, 0))).withColumn("__total", F.sum("__n").over(whole))
    asked = summed.withColumn("percent", F.explode(F.array(*[F.lit(p) for p in percents])))
    rank, before = F.ceil(F.col("__total") * F.col("percent") / 100), F.col("__upto") - F.col("__n")
    exact = F.when(F.col("__total") * F.col("percent") % 100 == 0, (F.col("__total") * F.col("percent") / 100).cast("bigint")).otherwise(rank)
    hit = asked.withColumn("__rank", F.greatest(exact, F.lit(1))).filter((before < F.col("__rank")) & (F.col("__rank") <= F.col("__upto")))
    hit = hit.select(*keys, "__bin", "percent", (F.col("__rank") - before).alias("__rank"))
    inside = counted.join(hit, [*keys, "__bin"])  # of each group one bin a percent
    order = Window.partitionBy(*keys, "percent", "__bin").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    reached = inside.withColumn("__upto", F.sum("__n").over(order)).filter(F.col("__upto") >= F.col("__rank"))
    return reached.groupBy(*keys, "percent").agg(F.min("__v").alias("value"))
