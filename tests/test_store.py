"""Tables that grow by batches: new files only, whole batches or nothing, folding, expiry and the index."""

import os
import random
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F

from duskwatch.sources import sinks
from duskwatch.sources.store import AppendTable, Manifest, event_store, newest, summed

SCHEMA = "session string, ts string, eventid string, src_ip string, n int"


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}


def opened(df):
    return {unquote(urlparse(f).path) for f in df.inputFiles()}


def batch(spark, *data):
    return spark.createDataFrame(data, SCHEMA)


def event(session, day, eventid="e", ip="192.0.2.1", n=0):
    return (session, f"2026-05-{day:02d}T00:00:00.000000Z", eventid, ip, n)


def test_a_batch_writes_new_files_only(spark, tmp_path):
    path = str(tmp_path)
    sinks.sink_events(batch(spark, event("a", 1), event("b", 2)), path)
    before = files(path)
    sinks.sink_events(batch(spark, event("a", 1, n=7), event("c", 1)), path)
    after = files(path)
    assert before.items() <= after.items() and len(after) > len(before)
    assert {(r["session"], r["n"]) for r in event_store(spark, path).read().collect()} == {("a", 7), ("b", 0), ("c", 0)}


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    path = str(tmp_path)
    assert sinks.sink_events(batch(spark, event("a", 1)), path, batch=4)
    before = files(path), event_store(spark, path).manifest()
    assert not sinks.sink_events(batch(spark, event("a", 1, n=9)), path, batch=4)
    assert not sinks.sink_events(batch(spark, event("z", 1)), path, batch=3)
    assert (files(path), event_store(spark, path).manifest()) == before


def test_a_crash_before_the_manifest_leaves_the_old_view(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    sinks.sink_events(batch(spark, event("a", 1)), path, batch=0)
    with monkeypatch.context() as m:
        m.setattr(AppendTable, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            sinks.sink_events(batch(spark, event("b", 1), event("b", 2), event("b", 3)), path, batch=1)
    store = event_store(spark, path)
    assert [r["session"] for r in store.read().collect()] == ["a"] and store.rows_of("session", ["b"]).count() == 0
    sinks.sink_events(batch(spark, event("b", 2), event("c", 2)), path, batch=1)  # the same version again, with other days
    assert sorted((r["session"], r["day"]) for r in store.read().collect()) == [("a", "2026-05-01"), ("b", "2026-05-02"), ("c", "2026-05-02")]
    store.vacuum()
    assert sorted((r["session"], r["day"]) for r in store.read().collect()) == [("a", "2026-05-01"), ("b", "2026-05-02"), ("c", "2026-05-02")]


def test_batches_folding_and_lookups_against_a_dictionary(spark, tmp_path):
    rng = random.Random(8)
    path, model = str(tmp_path), {}
    store = event_store(spark, path)
    for i in range(6):
        data = {}
        for _ in range(25):
            e = event(f"s{rng.randint(0, 9)}", rng.randint(1, 6), rng.choice("xyz"), f"192.0.2.{rng.randint(1, 4)}", i)
            data[e[:3]] = e
        model |= data
        sinks.sink_events(batch(spark, *data.values()), path, batch=i)
        if i == 3:
            assert store.compact() > 0
    asked = spark.createDataFrame([("s2",), ("s2",), ("s5",), ("none",), (None,)], "session string")

    def get(df):
        return sorted(tuple(r)[:5] for r in df.select(*[f.split()[0] for f in SCHEMA.split(", ")]).collect())

    assert get(store.read()) == sorted(model.values())
    assert get(store.read(between=("2026-05-02", "2026-05-03"))) == sorted(e for e in model.values() if e[1][8:10] in ("02", "03"))
    assert get(store.read(["2026-05-06"])) == sorted(e for e in model.values() if e[1][8:10] == "06")
    assert get(store.rows_of("session", ["s1", "s7"])) == sorted(e for e in model.values() if e[0] in ("s1", "s7"))
    assert get(store.rows_of("session", asked)) == sorted(e for e in model.values() if e[0] in ("s2", "s5"))
    assert get(store.rows_of("src_ip", ["192.0.2.3"], through="session")) == sorted(e for e in model.values() if e[3] == "192.0.2.3")
    assert store.compact() > 0 and store.compact() == 0
    store.vacuum(1)
    assert get(store.read()) == sorted(model.values())
    assert get(store.rows_of("session", ["s1"])) == sorted(e for e in model.values() if e[0] == "s1")
    assert len({f.rsplit("/", 2)[1] for f in files(path)}) == len(store.manifest().live)  # one folder a day, no other is left


def test_a_lookup_opens_only_the_files_of_its_keys(spark, tmp_path):
    path = str(tmp_path)
    for day in range(1, 11):
        sinks.sink_events(batch(spark, *[event(f"s{day}-{i}", day, ip=f"192.0.2.{day}") for i in range(20)], event("long", day, ip="198.51.100.1")), path)
    store, every = event_store(spark, path), files(path)
    one = store.rows_of("session", ["s4-7"])
    assert one.count() == 1 and len(opened(one)) == 1
    assert sum(os.path.getsize(f) for f in opened(one)) < sum(map(os.path.getsize, every)) / 5
    assert opened(store.rows_of("session", ["long"])) == set(every) and store.rows_of("session", ["long"]).count() == 10
    assert len(opened(store.rows_of("src_ip", ["192.0.2.9"], through="session"))) == 1
    assert store.rows_of("src_ip", ["192.0.2.9"], through="session").count() == 20
    assert store.rows_of("session", []).count() == 0 and store.rows_of("session", ["none"]).count() == 0
    assert all("day=2026-05-03" in f for f in opened(store.read(["2026-05-03"])))


def test_expired_days_are_gone_and_stay_away(spark, tmp_path):
    path = str(tmp_path)
    day_us = 86_400_000_000
    now = 1_780_000_000_000_000 // day_us * day_us  # a midnight
    start = now - sinks.RETENTION_US["event"]
    rows = spark.createDataFrame([(k, start + d * day_us + 1) for k, d in (("old", -2), ("older", -30), ("border", 0), ("new", 5))], "session string, us bigint")
    rows = rows.select("session", F.date_format(F.timestamp_micros("us"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"), F.lit("e").alias("eventid"))
    sinks.sink_events(rows, path, batch=0)
    store = event_store(spark, path)
    kept = files(path)
    assert sinks.drop_expired(store, "event", now) == 2
    assert sorted(r["session"] for r in store.read().collect()) == ["border", "new"]
    assert len(files(path)) == len(kept) - 2 and files(path).items() <= kept.items()
    assert not sinks.sink_events(rows, path, batch=0)
    assert sorted(r["session"] for r in store.read().collect()) == ["border", "new"]
    assert sinks.drop_expired(store, "event", now) == 0


def test_later_columns_sums_and_empty_batches(spark, tmp_path):
    table = AppendTable(spark, f"{tmp_path}/t", "day", summed(("day", "k"), ("n",)))
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.manifest() == Manifest()
    frame = lambda *data: spark.createDataFrame(data, "day string, k string, n bigint")
    table.append(frame(("1", "a", 2), ("2", "a", 1)), 0, note="x")
    table.append(frame(), 1)
    assert table.manifest().note == "x" and table.manifest().applied == 1
    table.append(frame(("1", "a", 5), ("1", None, 1)), 2, note="y")
    assert sorted(map(tuple, table.read().collect()), key=str) == [("1", "a", 7), ("1", None, 1), ("2", "a", 1)]
    wide = AppendTable(spark, f"{tmp_path}/w", "day", newest(("k",)))
    wide.append(frame(("1", "a", 2)), 0)
    wide.append(frame(("1", "b", 3)).withColumn("more", F.lit("m")), 1)
    assert sorted((r["k"], r["more"]) for r in wide.read().collect()) == [("a", None), ("b", "m")]
    with pytest.raises(ValueError):
        wide.rows_of("k", ["a"])
