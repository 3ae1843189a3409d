"""End-to-end ingest with proxy rows before, after and between the events."""

import json

import pytest
from pyspark.sql import functions as F

from duskwatch.plans import streams
from duskwatch.sources.store import event_store
from duskwatch.sources.telemetry import Telemetry
from duskwatch.streaming.resolve import ingest_resolved, proxy_store

LOOP, CLIENT = "127.0.0.1", "198.51.100.7"


def event(second, session="s", src_ip=LOOP, eventid="cowrie.login.failed"):
    return {"eventid": eventid, "timestamp": f"2026-05-07T00:00:{second:02d}.500000Z", "src_ip": src_ip, "session": session, "sensor": "hp", "username": "root", "password": "x"}


PROXY = {
    "time": "2026-05-07T00:00:10.200000Z", "client_ip": CLIENT, "client_port": 4000, "frontend_port": 22, "duration": "1",
    "bytes_uploaded": "2", "bytes_downloaded": "3", "status": "cD",
}


@pytest.mark.parametrize("order", ["before", "after", "between"])
def test_one_state_whatever_comes_first(spark, tmp_path, order):
    geo = spark.createDataFrame([(3325256704, 3325256959, "DE", 24940, "Org")], "lo bigint, hi bigint, country string, asn bigint, asn_org string")
    words = spark.createDataFrame([("x",)], "word string")
    paths = {n: f"{tmp_path}/{n}" for n in ("store", "proxies", "quarantine", "checkpoint")}

    def land(kind, name, *lines):
        folder = tmp_path / "raw" / kind
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")

    def run():
        ingest_resolved(spark, f"{tmp_path}/raw", geo_ranges=geo, dictionary=words, **paths)
        rows = event_store(spark, paths["store"]).read() if (tmp_path / "store").exists() else None
        return None if rows is None else {(r["session"], r["ts"][17:19]): (r["src_ip"], r["country"], r["correlation_status"]) for r in rows.collect()}

    first = lambda: land("cowrie", "a.json", event(10), event(10, "other", "192.0.2.9"), "{bad")
    second = lambda: land("cowrie", "b.json", event(20), event(40, "lone"))
    proxy = lambda: land("haproxy", "p.json", PROXY, "not json")
    steps = {"before": (proxy, first, second), "after": (first, second, proxy), "between": (first, proxy, second)}[order]
    for step in steps:
        step()
        state = run()
    assert {k: v[:2] for k, v in state.items()} == {("s", "10"): (CLIENT, "DE"), ("s", "20"): (CLIENT, "DE"), ("other", "10"): ("192.0.2.9", None), ("lone", "40"): (LOOP, None)}
    assert state[("s", "10")][2] == "matched" and state[("s", "20")][2] == ("matched" if order == "after" else "matched_inherited")
    assert state[("lone", "40")][2] == "missed" and state[("other", "10")][2] is None
    assert run() == state
    assert proxy_store(spark, paths["proxies"]).read().count() == 1
    assert [r[0] for r in spark.read.parquet(paths["quarantine"]).select(F.col("line")).collect()] == ["{bad"]


def test_landed_lines_are_cut_into_files(spark, tmp_path, monkeypatch):
    ts = F.expr("timestamp_ntz'2024-01-05 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, id)")
    kind = F.element_at(F.array(*map(F.lit, ("view", "error"))), (F.col("id") % 2 + 1).cast("int"))
    events = spark.range(400).select(F.col("id").alias("event_id"), ts.alias("ts"), (F.col("id") % 7).alias("user_id"), kind.alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k": 4}').alias("props"))
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(3).select(F.col("id").cast("int").alias("n_nationkey"), F.lit("x").alias("n_name")).write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(3).select(F.lit("Brand#11").alias("p_brand")).write.parquet(f"{tmp_path}/part.parquet")
    seen = []

    def ingest(session, raw, **options):
        lines = session.read.option("recursiveFileLookup", True).text(raw)
        seen.append((len(lines.inputFiles()), lines.count()))

    monkeypatch.setattr(streams, "ingest_resolved", ingest)
    monkeypatch.setattr(streams, "landing_files", lambda s: 3)
    with pytest.raises(FileNotFoundError):  # nothing is stored here
        streams.stream_resolve(Telemetry(spark, str(tmp_path)))
    early = events.filter("event_type = 'view' AND user_id % 2 = 0").count()
    assert seen == [(6, 400 + early), (9, 600)]
