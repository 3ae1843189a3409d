import gzip
import json
import random
import os
import time

import pytest
from pyspark.sql import functions as F

from duskwatch.operators.rollup import session_summaries
from duskwatch.sources.store import event_store
from duskwatch.streaming import counters as S
from duskwatch.streaming import rolling as R
from duskwatch.streaming import stateful as K
from duskwatch.streaming.correlate import correlated, instant_table, maintain_correlation, tunnelled_table
from duskwatch.streaming.ingest import ingest_events
from duskwatch.streaming.inherit import first_table, inherited, inherited_of, maintain_inheritance, take_first
from duskwatch.streaming.run import drain_to_files, stream_parquet, use_rocksdb

SEC = 1_000_000
T = 1778115301950000
FAR = T + 10 * 86_400 * SEC


@pytest.fixture(autouse=True)
def rocksdb(spark):
    use_rocksdb(spark)


class Feed:
    """Lands batches one after the other and drains a stream after each."""

    def __init__(self, spark, tmp_path, schema, build):
        self.spark, self.base, self.schema, self.build = spark, str(tmp_path), schema, build
        self.spark.createDataFrame([], schema).write.parquet(f"{self.base}/in")

    def add(self, data, label="in"):
        df = self.spark.createDataFrame(data, self.schema).withColumn("event_time", F.timestamp_micros("ts_us"))
        df.write.mode("append").parquet(f"{self.base}/{label}")

    def drain(self):
        schema = self.spark.createDataFrame([], self.schema).withColumn("event_time", F.timestamp_micros("ts_us")).schema
        stream = self.build(self.spark.readStream.schema(schema).parquet(f"{self.base}/in"))
        drain_to_files(stream, f"{self.base}/out", f"{self.base}/cp")
        self.result = self.spark.read.schema(stream.schema).parquet(f"{self.base}/out")
        return self.result


EVENT = {"timestamp": "2026-05-07T00:55:01.950000Z", "src_ip": "198.51.100.7", "sensor": "hp", "eventid": "cowrie.login.failed", "username": "root"}


def test_ingest_takes_each_object_once_and_quarantines(spark, tmp_path, rows):
    geo = spark.createDataFrame([(3325256704, 3325256959, "DE", 1, "One")], "lo bigint, hi bigint, country string, asn bigint, asn_org string")
    words = spark.createDataFrame([("123456",)], "word string")
    raw = tmp_path / "raw"
    raw.mkdir()
    paths = {n: str(tmp_path / n) for n in ("store", "quarantine", "checkpoint")}

    def land(name, lines):
        with gzip.open(raw / name, "wt") as fh:
            fh.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))

    def run():
        ingest_events(spark, str(raw), geo_ranges=geo, dictionary=words, **paths)

    land("a.json.gz", [EVENT | {"session": "a", "password": "123456"}, EVENT | {"session": "b", "password": "hidden"}, "{bad"])
    run()
    run()
    land("b.json.gz", [EVENT | {"session": "c", "password": "123456"}, EVENT | {"session": "a", "password": "other"}, EVENT | {"session": "d"}])
    run()
    store = event_store(spark, paths["store"]).read()
    assert rows(store, "session", "password", "password_raw", "country") == [
        ("a", "<filtered:len=5>", "other", "DE"), ("b", "<filtered:len=6>", "hidden", "DE"), ("c", "123456", None, "DE"),
    ]
    bad = rows(spark.read.parquet(paths["quarantine"]).select(F.col("failed_rules")[0].alias("r"), "batch_id"))
    assert bad == [("cowrie.login.failed_needs_username_password", 1), ("not_json", 0)]


def test_dedup_across_batches(spark, tmp_path):
    feed = Feed(spark, tmp_path, "change_id string, ts_us bigint", lambda s: S.dedup_stream(s, "change_id", "event_time"))
    feed.add([("x", T), ("x", T), ("y", T), (None, T)])
    feed.drain()
    feed.add([("x", T + 60 * SEC), (None, T + 60 * SEC), ("z", T)])
    assert sorted(str(r[0]) for r in feed.drain().select("change_id").collect()) == ["None", "None", "x", "y", "z"]


def test_change_feed_decoding(spark):
    def rec(name="INSERT", image=None, eid="1"):
        return json.dumps({"eventID": eid, "eventName": name, "dynamodb": {"NewImage": image} if image is not None else {}})

    event = {"type": {"S": "EVENT"}, "asn": {"N": "24940"}, "ok": {"BOOL": True}, "gone": {"NULL": True}, "ips": {"L": [{"S": "a"}, {"N": "1"}]}, "m": {"M": {"k": {"N": "2"}}}}
    lines = [rec(image=event), rec("MODIFY", event), rec("REMOVE", event), rec(), rec(image={}), rec(image={"type": {"S": "RANK"}}), rec(image={"asn": {"N": "1"}})]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    out = S.decode_changes(df, {"asn": "bigint", "ok": "string", "gone": "string", "ips": "string", "m": "string"})
    outcomes = [r["outcome"] for r in out.collect()]
    assert outcomes == ["processed"] * 2 + ["skipped"] * 3 + ["skipped_non_event"] * 2
    assert tuple(out.first())[2:] == (24940, "true", None, '["a","1"]', '{"k":"2"}')


def test_hourly_counts_take_late_rows_within_an_hour(spark, tmp_path, rows):
    schema = "username string, password string, country string, asn bigint, eventid string, ts_us bigint"

    def add(*data):
        df = spark.createDataFrame([(u, None, None, None, None, t) for u, t in data], schema)
        df.withColumn("event_time", F.timestamp_micros("ts_us")).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        S.maintain_hourly_counts(stream_parquet(spark, f"{tmp_path}/in"), f"{tmp_path}/t", f"{tmp_path}/cp")
        return rows(S.stored_counters(spark, f"{tmp_path}/t"), "bucket", "value", "count")

    add(("a", T), ("a", T + SEC), ("b", T))
    assert run() == [("2026-05-07T00", "a", 2), ("2026-05-07T00", "b", 1)]
    add(("a", T + 3600 * SEC), ("a", T + 2 * SEC))
    assert run() == [("2026-05-07T00", "a", 3), ("2026-05-07T00", "b", 1), ("2026-05-07T01", "a", 1)]
    assert run() == [("2026-05-07T00", "a", 3), ("2026-05-07T00", "b", 1), ("2026-05-07T01", "a", 1)]


EV, PX = "event_id bigint, ts_us bigint, src_ip string", "ts_us bigint, client_ip string"
LOOP = "127.0.0.1"


class TwoLogs:
    """An event and a proxy log that grow, correlated after each step."""

    def __init__(self, spark, base):
        self.spark, self.base = spark, base
        self.land([], [])

    def land(self, events, clients):
        for name, data, schema in (("ev", events, EV), ("px", clients, PX)):
            df = self.spark.createDataFrame(data, schema)
            df.withColumn("event_time", F.timestamp_micros("ts_us")).write.mode("append").parquet(f"{self.base}/{name}")

    def run(self, **options):
        sides = [stream_parquet(self.spark, f"{self.base}/{name}") for name in ("ev", "px")]
        maintain_correlation(*sides, f"{self.base}/out", f"{self.base}/cp", **options)
        return {r["event_id"]: (r["candidates"], r["status"], r["src_ip"]) for r in correlated(self.spark, f"{self.base}/out").collect()}


def outcome(t, clients, window_us=500_000, floor_us=1_000):
    near = [ip for p, ip in clients if p is not None and ip is not None and t - window_us <= p <= t - floor_us]
    return (len(near), ["missed", "matched", "ambiguous"][min(len(near), 2)], near[0] if len(near) == 1 else LOOP)


@pytest.mark.parametrize("proxy_first", [True, False])
def test_stream_correlation_in_either_order(spark, tmp_path, proxy_first):
    logs = TwoLogs(spark, tmp_path)
    events = [(1, T, LOOP), (2, T + 10 * SEC, LOOP), (3, T + 20 * SEC, LOOP), (4, T, "192.0.2.1")]
    clients = [(T - 500_000, "198.51.100.1"), (T + 20 * SEC - 1_000, "198.51.100.2"), (T + 20 * SEC - 2_000, "198.51.100.3"), (T - 999, "198.51.100.4")]
    steps = [([], clients), (events, [])]
    for step in steps if proxy_first else reversed(steps):
        logs.land(*step)
        assert logs.run() == {}
    logs.land([(-1, FAR, LOOP)], [])
    assert logs.run() == {}  # the proxy log is silent
    logs.land([], [(FAR, None)])
    want = {1: (1, "matched", "198.51.100.1"), 2: (0, "missed", LOOP), 3: (2, "ambiguous", LOOP)}
    assert logs.run() == want
    assert logs.run() == want


def test_stream_correlation_corrected_by_late_rows(spark, tmp_path):
    """Rows of both logs in four shuffled micro-batches, the later ones for chunks swept already, give what all rows at once give."""
    rng = random.Random(3)
    span = 40 * SEC
    events = [(i, T + rng.randrange(span), LOOP) for i in range(120)] + [(500, None, LOOP), (501, T, "192.0.2.9")]
    clients = [(T + rng.randrange(span), f"198.51.100.{rng.randrange(9)}") for _ in range(90)] + [(None, "198.51.100.1"), (T, None)]
    logs = TwoLogs(spark, tmp_path)
    options = {"chunk_us": 5 * SEC, "delay_us": SEC, "fold": 2}
    for part in range(4):
        logs.land(events[part::4] + [(900 + part, T + span + (part + 20) * SEC, LOOP)], clients[part::4] + [(T + span + (part + 20) * SEC, None)])
        got = logs.run(**options)
        come = [c for p in range(part + 1) for c in clients[p::4]]
        assert {k: v for k, v in got.items() if k < 900} == {
            i: outcome(t, come) for p in range(part + 1) for i, t, ip in events[p::4] if t is not None and ip == LOOP
        }


def test_stream_correlation_stores_a_burst_as_instants(spark, tmp_path):
    """10,000 connections in one window are three stored instants and no pairs, for any number of events."""
    logs = TwoLogs(spark, tmp_path)
    burst = [(T + i % 3, f"198.51.100.{i % 200}") for i in range(10_000)]
    logs.land([(i, T + 100_000, LOOP) for i in range(50)] + [(-1, FAR, LOOP)], burst + [(FAR, None)])
    assert logs.run() == {i: (10_000, "ambiguous", LOOP) for i in range(50)}
    assert instant_table(spark, f"{tmp_path}/out").read().count() == 3
    assert tunnelled_table(spark, f"{tmp_path}/out").read().count() == 51


SESSION = "session string, ts string, ts_us bigint, eventid string, username string, duration double"


def test_sessions_across_batches_and_timeout(spark, tmp_path, rows):
    feed = Feed(spark, tmp_path, SESSION, lambda s: K.session_summary_stream(s, watermark="1 minute", keep_ms=60_000))
    failed = [("a", "t", T + i * SEC, "cowrie.login.failed", f"u{i % 3}", None) for i in range(6)]
    feed.add(failed + [("a", "t", T, "cowrie.command.input", "x", None), ("b", "t", T, "cowrie.login.failed", "u", None)])
    assert rows(feed.drain()) == []
    feed.add([("a", "end", T + 9 * SEC, "cowrie.session.closed", None, None), ("a", "t", T + 8 * SEC, "cowrie.login.success", "u9", None)])
    assert rows(feed.drain()) == [("a", "end", 0.0, 6, 1, 4, 1)]
    feed.add([("c", "t", T + 3600 * SEC, "cowrie.session.closed", None, 1.0)])  # moves time past b's timeout
    feed.drain()
    feed.add([("b", "late", T + 3600 * SEC, "cowrie.session.closed", None, 1.5)])
    assert rows(feed.drain()) == [("a", "end", 0.0, 6, 1, 4, 1), ("b", "late", 1.5, 0, 0, 0, 0), ("c", "t", 1.0, 0, 0, 0, 0)]


def test_inheritance_across_batches(spark, tmp_path, rows):
    schema = "event_id bigint, session string, ts_us bigint, eventid string, src_ip string, status string"
    feed = Feed(spark, tmp_path, schema, lambda s: K.inherit_stream(s))
    loop = "127.0.0.1"
    feed.add([(1, "a", T, "e", loop, "missed"), (2, "a", T + 1, "e", "198.51.100.7", "matched"), (3, "a", T + 2, "e", loop, "missed"), (4, "b", T, "e", loop, "missed")])
    feed.drain()
    feed.add([(5, "a", T + 30 * SEC, "e", "198.51.100.9", "matched"), (6, "a", T + 31 * SEC, "e", "192.0.2.1", None), (7, "b", T + 30 * SEC, "e", loop, "ambiguous")])
    feed.drain()
    feed.add([(8, "z", FAR, "e", loop, "missed")])  # moves the watermark past all others
    assert rows(feed.drain(), "event_id", "src_ip", "status") == [
        (1, loop, "missed"), (2, "198.51.100.7", "matched"), (3, "198.51.100.7", "matched_inherited"), (4, loop, "missed"),
        (5, "198.51.100.7", "matched_inherited"), (6, "192.0.2.1", None), (7, loop, "ambiguous"),
    ]


def test_stored_inheritance_with_late_rows(spark, tmp_path):
    """Three micro-batches, a session over 40 days, earlier matches that come late, ties, rows without session or time."""
    rng = random.Random(11)
    schema = "event_id bigint, session string, ts_us bigint, eventid string, src_ip string, status string"
    names = ["hot"] * 6 + ["a", "b", "c", None]
    data = [
        (i, rng.choice(names), T + rng.randrange(40) * 86_400 * SEC, rng.choice(["e", "f", None]), rng.choice([f"198.51.100.{i}", None]),
         rng.choice(["matched", "missed", "ambiguous", None]))
        for i in range(150)
    ] + [(900, "a", None, "e", "198.51.100.1", "matched"), (901, "only", T, "e", "x", "missed")]
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/in")

    def run():
        maintain_inheritance(stream_parquet(spark, f"{tmp_path}/in"), f"{tmp_path}/t", f"{tmp_path}/cp", fold=2)

    def shown(df):
        return {r["event_id"]: (r["src_ip"], r["status"]) for r in df.collect()}

    def plain(rows):
        first, out = {}, {}
        for i, s, t, e, ip, status in sorted((r for r in rows if r[2] is not None), key=lambda r: (r[2], r[3] or "", r[0])):
            out[i] = (first[s], "matched_inherited") if s in first and status else (ip, status)
            if s is not None and status == "matched":
                first.setdefault(s, ip)
        return out

    for part in range(3):
        spark.createDataFrame(data[part::3], schema).write.mode("append").parquet(f"{tmp_path}/in")
        run()
        come = [r for p in range(part + 1) for r in data[p::3]]
        assert shown(inherited(spark, f"{tmp_path}/t")) == plain(come)
    run()
    want = plain(data)
    assert shown(inherited(spark, f"{tmp_path}/t")) == want
    assert shown(inherited_of(spark, f"{tmp_path}/t", ["a", "none"])) == {r[0]: want[r[0]] for r in data if r[1] == "a" and r[0] in want}
    day = F.timestamp_micros(F.lit(T)).cast("date").cast("string")
    today = spark.range(1).select(day).first()[0]
    assert shown(inherited(spark, f"{tmp_path}/t", between=(today, today))) == {r[0]: want[r[0]] for r in data if r[2] == T}
    rows = spark.createDataFrame(data, schema).filter("ts_us IS NOT NULL")
    assert shown(take_first(rows, first_table(spark, f"{tmp_path}/t").read(), hot_rows=20)) == want  # the hot session by broadcast


def test_rolling_counts_across_batches(spark, tmp_path):
    schema = "source_event string, src_ip string, ts_us bigint, username string"
    feed = Feed(spark, tmp_path, schema, lambda s: K.rolling_count_stream(s, width_us=300 * SEC))
    feed.add([(f"e{i}", "a", T + i * SEC, f"u{i % 2}") for i in range(4)])
    feed.drain()
    feed.add([("e4", "a", T + 300 * SEC, "u7"), ("e5", "a", T + 301 * SEC, None), ("f0", "b", T, "x")])
    feed.drain()
    feed.add([("far", "z", FAR, "x")])
    got = {r["source_event"]: (r["n_events"], r["n_distinct"]) for r in feed.drain().collect()}
    assert got == {"e0": (1, 1), "e1": (2, 2), "e2": (3, 2), "e3": (4, 2), "e4": (5, 3), "e5": (5, 3), "f0": (1, 1)}


@pytest.mark.parametrize("seed", [1, 2])
def test_cuts_into_batches_have_no_effect(spark, tmp_path, seed):
    """One key's rows shuffled over Arrow batches of 7 and three micro-batches give what sorted rows give at once."""
    rng = random.Random(seed)
    events = [(i, "s", T + rng.randrange(900) * SEC, "e", f"198.51.100.{i}", rng.choice(["matched", "missed", None])) for i in range(60)]
    failed = [(f"e{i}", "a", T + rng.randrange(900) * SEC, f"u{rng.randrange(5)}") for i in range(60)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        one = Feed(spark, tmp_path / "i", "event_id bigint, session string, ts_us bigint, eventid string, src_ip string, status string", lambda s: K.inherit_stream(s))
        two = Feed(spark, tmp_path / "r", "source_event string, src_ip string, ts_us bigint, username string", lambda s: K.rolling_count_stream(s, width_us=100 * SEC, watermark="1 hour"))
        for part in range(3):
            one.add(events[part::3])
            one.drain()
            two.add(failed[part::3])
            two.drain()
        one.add([(99, "z", FAR, "e", "x", None)])
        two.add([("far", "z", FAR, "x")])
        got = {r["event_id"]: (r["src_ip"], r["status"]) for r in one.drain().collect()}
        counts = {r["source_event"]: (r["n_events"], r["n_distinct"]) for r in two.drain().collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    ip, want = None, {}
    for i, _, _, _, src, status in sorted(events, key=lambda e: (e[2], e[3], e[0])):
        want[i] = (ip, "matched_inherited") if ip and status else (src, status)
        ip = ip or (src if status == "matched" else None)
    assert got == want
    trailing = {e: [(x, u) for x, _, y, u in failed if t - 100 * SEC <= y <= t] for e, _, t, _ in failed}
    assert counts == {e: (len(v), len({u for _, u in v})) for e, v in trailing.items()}


def test_threshold_stream(spark, tmp_path, rows):
    feed = Feed(spark, tmp_path, "src_ip string, ts_us bigint", lambda s: K.threshold_stream(s))
    base = T // (60 * SEC) * 60 * SEC
    feed.add([("a", base + i) for i in range(6)] + [("b", base + i) for i in range(4)])
    feed.drain()
    feed.add([("z", base + 600 * SEC)])
    assert rows(feed.drain()) == [("a", base, 6, base + 5)]


def test_hourly_counts_take_rows_of_any_lateness(spark, tmp_path, rows):
    """Batches out of time order give the counts of all rows at once, and closed hours are listed."""
    schema = "username string, password string, country string, asn bigint, eventid string, ts_us bigint"
    hour = 3600 * SEC

    def run(*data):
        df = spark.createDataFrame([(u, None, None, None, None, t) for u, t in data], schema)
        df.withColumn("event_time", F.timestamp_micros("ts_us")).write.mode("append").parquet(f"{tmp_path}/in")
        S.maintain_hourly_counts(stream_parquet(spark, f"{tmp_path}/in"), f"{tmp_path}/t", f"{tmp_path}/cp")
        return rows(S.stored_counters(spark, f"{tmp_path}/t"), "bucket", "value", "count")

    run(("a", T), ("a", T + 30 * hour))
    run(("a", T + 1), ("b", T + 40 * hour))
    assert run(("a", T + 2), ("b", T - 48 * hour)) == [
        ("2026-05-05T00", "b", 1), ("2026-05-07T00", "a", 3), ("2026-05-08T06", "a", 1), ("2026-05-08T16", "b", 1),
    ]
    assert rows(S.late_counts(spark, f"{tmp_path}/cp"), "bucket", "value", "count", "batch") == [
        ("2026-05-05T00", "b", 1, 2), ("2026-05-07T00", "a", 1, 1), ("2026-05-07T00", "a", 1, 2),
    ]


def test_repeated_batch_adds_nothing(spark, tmp_path, rows):
    table = S.counter_table(spark, f"{tmp_path}/t")

    def add(batch_id, n):
        fresh = spark.createDataFrame([("2026-05-07T00", "username", "a", n, "2026-05-07")], "bucket string, dimension string, value string, count bigint, day string")
        return table.append(fresh, batch_id), rows(table.read(), "count")

    assert [add(0, 2), add(0, 2), add(1, 3), add(1, 3), add(2, 1)] == [(True, [(2,)]), (False, [(2,)]), (True, [(5,)]), (False, [(5,)]), (True, [(6,)])]


def test_session_summaries_are_whole_however_late(spark, tmp_path, rows):
    schema = "session string, ts string, eventid string, username string, duration double"

    def run(*data):
        spark.createDataFrame(data, schema).write.mode("append").parquet(f"{tmp_path}/in")
        S.maintain_session_summaries(stream_parquet(spark, f"{tmp_path}/in"), f"{tmp_path}/t", f"{tmp_path}/cp", fold=2)

    run(("b", "2026-05-01T00", "cowrie.login.failed", "u", None), ("d", "2026-05-07T01", "cowrie.session.closed", None, 1.0))
    run(("c", "2026-05-07T00", "cowrie.session.closed", None, None))
    run(("b", "2026-05-07T02", "cowrie.session.closed", None, 1.5))
    run(("c", "2026-05-01T00", "cowrie.command.input", None, None), ("b", "2026-04-01T00", "cowrie.login.success", "v", None))
    assert rows(S.session_summary(spark, f"{tmp_path}/t", ["c"])) == [("c", "2026-05-07T00", 0.0, 0, 0, 0, 1)]
    assert rows(S.session_summary(spark, f"{tmp_path}/t")) == [
        ("b", "2026-05-07T02", 1.5, 1, 1, 2, 0), ("c", "2026-05-07T00", 0.0, 0, 0, 0, 1), ("d", "2026-05-07T01", 1.0, 0, 0, 0, 0),
    ]


def test_sessions_of_many_cut_batches_equal_the_batch_summaries(spark, tmp_path, rows):
    """Events in any order over many batches, one of them seen twice, against the batch job on all of them."""
    rng = random.Random(5)
    kinds = ["cowrie.login.failed", "cowrie.login.success", "cowrie.command.input", "cowrie.session.closed", "cowrie.other"]
    schema = "session string, ts string, eventid string, username string, duration double"
    data = [
        (rng.choice(["hot"] * 6 + ["a", "b", "c", "", None]), f"2026-05-{rng.randint(1, 20):02d}T00:{i % 60:02d}", rng.choice(kinds), rng.choice(["u", "v", "w", None]), rng.choice([None, 0.5, 3.0]))
        for i in range(300)
    ]
    frame = spark.createDataFrame(data, schema)
    whole = session_summaries(frame)
    for i in range(6):
        part = spark.createDataFrame(data[i::6], schema)
        S.session_table(spark, f"{tmp_path}/t").append(S.session_parts(part), i)
        S.session_table(spark, f"{tmp_path}/t").append(S.session_parts(part), i)
        if i == 3:
            S.session_table(spark, f"{tmp_path}/t").compact()
    columns = [c.split()[0] for c in S.SESSIONS.split(", ")]
    assert rows(S.session_summary(spark, f"{tmp_path}/t"), *columns) == rows(whole, *columns)


def trailing_by_hand(rows, width):
    return {e: (len(v), len({u for u in v if u is not None})) for e, ip, t, _ in rows for v in [[u for _, j, x, u in rows if j == ip and t - width <= x <= t]]}


@pytest.mark.parametrize("seed,per_batch", [(3, 1), (4, 2)])
def test_rolling_counts_take_late_rows(spark, tmp_path, seed, per_batch):
    """Rows in no order over several micro-batches, chunks swept early and again, against all rows at once."""
    rng = random.Random(seed)
    width = 100 * SEC
    failed = [(f"e{i}", rng.choice("aab"), T + rng.randrange(1500) * SEC, rng.choice([None, "u", "v", "w"])) for i in range(90)]
    for part in [[("early", "z", T + 900 * SEC, "x")], *[failed[i::4] for i in range(4)], [("far", "z", FAR, "x")]]:
        spark.createDataFrame(part, "source_event string, src_ip string, ts_us bigint, username string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = stream_parquet(spark, f"{tmp_path}/in", files_per_batch=per_batch)
        R.maintain_rolling_counts(stream, f"{tmp_path}/t", f"{tmp_path}/cp", width_us=width, delay_us=5 * SEC, fold=2)
    got = {r["source_event"]: (r["n_events"], r["n_distinct"]) for r in R.rolling_counts(spark, f"{tmp_path}/t").collect()}
    want = trailing_by_hand([*failed, ("early", "z", T + 900 * SEC, "x")], width)
    assert got == want


def test_a_late_row_changes_the_counts_after_it(spark, tmp_path):
    def run(*data):
        spark.createDataFrame(data, "source_event string, src_ip string, ts_us bigint, username string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        R.maintain_rolling_counts(stream_parquet(spark, f"{tmp_path}/in"), f"{tmp_path}/t", f"{tmp_path}/cp", width_us=60 * SEC, keep="n_events >= 2")
        return {r["source_event"]: r["n_events"] for r in R.rolling_counts(spark, f"{tmp_path}/t").collect()}

    base = T // (60 * SEC) * 60 * SEC
    assert run(("a", "s", base + 59 * SEC, "u"), ("b", "s", base + 61 * SEC, "u"), ("far", "z", base + 3600 * SEC, "u")) == {"b": 2}
    assert run(("late", "s", base + 50 * SEC, "u")) == {"a": 2, "b": 3}
    assert run(("other", "q", base + 50 * SEC, "u")) == {"a": 2, "b": 3}
