"""Maintained rollups after batches in any order against the batch jobs on all events."""

import random
from datetime import datetime
from types import SimpleNamespace

from pyspark.sql import functions as F

from duskwatch.operators import reports, rollup
from duskwatch.operators.rank import top_ranks
from duskwatch.plans import rollups as plans
from duskwatch.streaming import rollups
from duskwatch.streaming.counters import SESSION_SUMS, session_parts
from duskwatch.streaming.run import stream_parquet

NOW = datetime(2026, 5, 9, 13, 20)
SCHEMA = (
    "ts string, session string, src_ip string, eventid string, username string, password string, country string, asn bigint, "
    "input string, dst_port bigint, duration double"
)
KINDS = ("cowrie.login.failed", "cowrie.login.success", "cowrie.session.closed", "cowrie.session.file_download", "cowrie.command.input", "cowrie.direct-tcpip.request")


def events(seed, n):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        kind = rng.choice(KINDS)
        out.append((
            f"2026-05-{rng.randint(1, 9):02d}T{rng.randint(0, 23):02d}:10:00.{rng.randrange(10**6):06d}Z", rng.choice(["hot"] * 8 + ["a", "b", "c", ""]),
            rng.choice(["192.0.2.1", "192.0.2.2", "198.51.100.3", ""]), kind, f"u{rng.randrange(12)}" if "login" in kind else None, rng.choice(["p", None]),
            rng.choice(["DE", "US", None]), rng.choice([1, 2, None]), "ls -l" if "command" in kind else None, rng.choice([22, 80, None]), rng.choice([None, 0.5, 9.0]) if "closed" in kind else None,
        ))
    return out


def test_reports_from_rollups(spark, tmp_path, rows):
    data = events(3, 240)
    path = f"{tmp_path}/t"

    def frame(part):
        return spark.createDataFrame(part, SCHEMA).withColumn("event_time", F.to_timestamp("ts"))

    for i in range(4):  # sessions are cut apart, and days come in no order
        frame(data[i::4]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        rollups.maintain_rollups(stream_parquet(spark, f"{tmp_path}/in"), path, f"{tmp_path}/cp", fold=2)
    whole = frame(data).cache()
    labels = rollup.technique_hourly(whole)

    counted = rollups.hours(spark, path).read().unionByName(rollups.techniques(spark, path).read().filter("count <> 0"))
    columns = ("bucket", "dimension", "value", "count")
    assert rows(counted, *columns) == rows(rollup.all_counters(whole), *columns)
    assert rows(rollups.ranks(spark, path, NOW)) == rows(top_ranks(rollup.trailing_totals(rollup.all_counters(whole), NOW)))
    daily = rollup.daily_summary(whole, labels)
    flat = daily.select("*", *[F.coalesce(F.col("techniques")[x], F.lit(0).cast("bigint")).alias(x) for x in rollup.TECHNIQUES]).drop("techniques")
    assert rows(rollups.daily_summaries(spark, path), *flat.columns) == rows(flat)
    spans = {"24h": 24, "7d": 168}
    assert rows(rollups.breakdown(spark, path, NOW, spans)) == rows(rollup.technique_breakdowns(labels, NOW, spans))
    assert rows(rollups.timeline_hourly(spark, path, NOW, "7d")) == rows(reports.timeline_hourly(rollup.all_counters(whole), NOW, "7d"))
    assert rows(rollups.timeline_daily(spark, path, NOW, "7d")) == rows(reports.timeline_daily(daily, NOW, "7d"))
    today = whole.filter(F.col("ts").startswith("2026-05-09"))
    card = rollups.summary_card(spark, path, NOW).first()
    assert (card["total"], card["unique_ips_24h"]) == (today.count(), today.filter("src_ip <> ''").select("src_ip").distinct().count())
    assert card["sensor_last_seen"] == max(e[0] for e in data)


def test_reports_open_their_days_only(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.createDataFrame(events(5, 200), SCHEMA).withColumn("event_time", F.to_timestamp("ts")).write.parquet(f"{tmp_path}/in")
    rollups.maintain_rollups(stream_parquet(spark, f"{tmp_path}/in"), path, f"{tmp_path}/cp")
    for df in (rollups.timeline_hourly(spark, path, NOW, "24h"), rollups.breakdown(spark, path, NOW, {"24h": 24}), rollups.daily_summaries(spark, path, ("2026-05-08", "2026-05-09"))):
        files = df.inputFiles()
        assert files and all(f"{path}/" in f and ("day=2026-05-08" in f or "day=2026-05-09" in f) for f in files)


def test_label_changes_scan_the_state_once_per_aggregate(spark, rows):
    new = spark.createDataFrame(events(7, 60), SCHEMA).withColumn("event_time", F.to_timestamp("ts"))
    old = spark.createDataFrame(events(8, 60), SCHEMA).withColumn("event_time", F.to_timestamp("ts"))
    both = old.unionByName(new)
    before, parts = session_parts(old), session_parts(new)
    found = rollups.label_changes(before, parts).select("bucket", "value", "count")
    was, now = [rollup.technique_hourly(x).select("bucket", "value", "count") for x in (old, both)]
    change = now.unionByName(was.withColumn("count", -F.col("count"))).groupBy("bucket", "value").agg(F.sum("count").alias("count")).filter("count <> 0")
    assert rows(found) == rows(change)
    assert rows(rollups.label_changes(before.limit(0), parts).select("bucket", "value", "count")) == rows(rollup.technique_hourly(new).select("bucket", "value", "count"))
    scans = spark.range(1).select(F.lit("x").alias("session"), F.lit(None).cast("string").alias("username"), F.lit("2026-05-09T01:00:00Z").alias("ts"), F.lit(1.0).alias("duration_seconds"), F.lit("1").alias("slot"), *[F.lit(1).cast("bigint").alias(c) for c in SESSION_SUMS])
    plan = rollups.label_changes(scans, parts)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 1") == 2  # once for the logins, once for the closings


def test_a_build_reads_batches_of_many_files(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(plans, "stream_parquet", lambda s, path, files_per_batch: seen.append((len(s.read.parquet(path).inputFiles()), files_per_batch)))
    monkeypatch.setattr(plans.rollups, "maintain_rollups", lambda *args, **kw: None)
    monkeypatch.setattr(plans, "landing_files", lambda s: 5)
    stored = spark.createDataFrame(events(9, 400), SCHEMA).withColumn("ts_us", F.unix_micros(F.to_timestamp("ts")))
    plans.build(SimpleNamespace(spark=spark, stored=stored))
    assert seen == [(20, 5)]
