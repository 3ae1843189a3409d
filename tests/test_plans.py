"""Plan shapes: no nested loops, filters at the scan, map-side cuts, spread keys."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from duskwatch.operators import correlate as C
from duskwatch.operators import rank, rollup
from duskwatch.operators.joins import interval_join, ip_range_join
from duskwatch.plans import landed, streams
from duskwatch.plans.registry import QUERIES, SQL
from duskwatch.session import use_utc
from duskwatch.sources.telemetry import Telemetry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample tables are not here")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


BATCH = [n for n, f in QUERIES.items() if f.__module__ not in (landed.__name__, streams.__name__)]


def test_no_nested_loop_even_without_broadcasts(spark, no_broadcast):
    queries = entry.queries()
    for name in BATCH:
        text = plan(queries[name](spark, FOLDER))
        assert "NestedLoop" not in text and "CartesianProduct" not in text, name


def test_every_query_has_a_sql_twin():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_time_range_reaches_the_scan(spark):
    use_utc(spark)
    t = Telemetry(spark, FOLDER).between("2024-01-30 00:00:00", "2024-01-31 00:00:00")
    text = plan(t.events.select("ts", "eventid"))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "value" not in text.split("ReadSchema")[1].split(">")[0]


def test_ranking_is_cut_before_the_shuffle(spark):
    totals = spark.createDataFrame([("24H", "username", "a", 1)], "window string, dimension string, value string, count bigint")
    text = plan(rank.top_ranks(totals))
    assert "row_number(), 25, Partial" in text


def test_small_range_table_is_broadcast_and_large_one_is_not(spark, monkeypatch, no_broadcast):
    from duskwatch.operators import joins

    ranges = spark.createDataFrame([(0, 10, "x"), (70_000, 80_000, "y")], "lo bigint, hi bigint, country string")
    ips = spark.createDataFrame([("0.0.0.1",)], "a string, b string".split(",")[0])
    assert "BroadcastHashJoin" in plan(ip_range_join(ips, "a", ranges))
    monkeypatch.setattr(joins.broadcast_if_small, "__defaults__", (None, 1))
    assert "BroadcastHashJoin" not in plan(ip_range_join(ips, "a", ranges))


def test_keyless_rows_are_spread(spark, no_broadcast):
    """Events without a loopback address must not all meet in the partition of the null key."""
    e = spark.range(1000).select(
        F.concat(F.lit("s"), "id").alias("session"), F.col("id").alias("ts_us"), F.col("id").cast("string").alias("ts"),
        F.concat(F.lit("192.0.2."), F.col("id") % 250).alias("src_ip"), F.lit("e").alias("eventid"),
    )
    p = spark.createDataFrame([(1, "x")], "ts_us bigint, client_ip string")
    text = plan(C.correlate_forward(e, p, list_candidates=False))
    assert "coalesce(__key" in text and "xxhash64" in text


def test_interval_join_is_an_equi_join(spark, no_broadcast):
    a, b = spark.range(10).withColumnRenamed("id", "a"), spark.range(10).withColumnRenamed("id", "b")
    assert "SortMergeJoin [__bucket" in plan(interval_join(a, b, left_time="a", right_time="b", lo=1, hi=3))


def test_counters_aggregate_before_the_shuffle(spark):
    df = spark.createDataFrame([("2026-05-07T00", "u")], "ts string, username string")
    text = plan(rollup._unpivot(df, {"username": F.col("username")}))
    assert "partial_count" in text and text.count("Exchange") == 1


def test_flagship_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["window", "dimension", "value", "count", "rank"] and df.count() > 0
