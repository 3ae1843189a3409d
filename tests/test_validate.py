import json

import pytest
from pyspark.sql import functions as F

from duskwatch.operators import projections as P
from duskwatch.operators import validate as V
from duskwatch.schemas import PUBLIC_COLUMNS
from duskwatch.sources.store import event_store
from duskwatch.sources import dims, logs, sinks

BASE = {
    "eventid": "cowrie.session.params", "timestamp": "2026-05-07T00:55:01.950000Z", "src_ip": "198.51.100.7",
    "session": "s1", "sensor": "hp1",
}


def land(tmp_path, lines, *below, name="part.json"):
    folder = tmp_path.joinpath(*below)
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    return str(tmp_path)


def failures(spark, tmp_path, *events):
    path = land(tmp_path, [BASE | {"session": f"n{i}"} | e for i, e in enumerate(events)], "raw", "cowrie")
    checked = V.check_events(logs.scan_events(spark, path))
    return [r[0] for r in checked.orderBy("line").select("failed_rules").collect()]


def good(spark, tmp_path, event):
    path = land(tmp_path, [BASE | event])
    checked = V.check_events(logs.scan_events(spark, path)).first()
    return checked["failed_rules"] == []


@pytest.mark.parametrize(
    "event",
    [
        {"eventid": "cowrie.session.connect", "src_port": 0, "dst_port": 65535},
        {"eventid": "cowrie.session.closed", "duration": "0.3"},
        {"eventid": "cowrie.session.closed", "duration": 0},
        {"eventid": "cowrie.something.new", "brand_new": {"a": 1}},
        {"message": []},
        {"eventid": "cowrie.client.kex", "hassh": "h", "kexAlgs": ["a", "b"], "langCS": [""]},
        {"src_ip": "2001:db8::1"},
        {"dst_port": "22", "protocol": "telnet"},
        {"session": "x" * 64},
        {"eventid": "cowrie.login.failed", "username": "", "password": ""},
    ],
)
def test_accepted(spark, tmp_path, event):
    assert good(spark, tmp_path, event)


@pytest.mark.parametrize(
    "event, rule",
    [
        ({"eventid": "cowrie.session.connect", "src_port": 1}, "cowrie.session.connect_needs_src_port_dst_port"),
        ({"eventid": "cowrie.login.failed", "username": "a"}, "cowrie.login.failed_needs_username_password"),
        ({"eventid": "cowrie.command.input"}, "cowrie.command.input_needs_input"),
        ({"eventid": "cowrie.session.file_download", "url": "u"}, "cowrie.session.file_download_needs_url_shasum"),
        ({"eventid": "cowrie.session.closed"}, "cowrie.session.closed_needs_duration"),
        ({"eventid": "cowrie.client.version"}, "cowrie.client.version_needs_version"),
        ({"eventid": "cowrie.client.kex"}, "cowrie.client.kex_needs_hassh"),
        ({"timestamp": "2026-05-07T00:55:01.950000+00:00"}, "timestamp_format"),
        ({"timestamp": "2026-02-30T00:55:01Z"}, "timestamp_format"),
        ({"src_ip": "999.1.1.1"}, "src_ip_format"),
        ({"dst_ip": ""}, "dst_ip_format"),
        ({"eventid": "ssh.login.failed"}, "eventid_format"),
        ({"session": ""}, "session_length"),
        ({"session": "x" * 65}, "session_length"),
        ({"sensor": ""}, "sensor_empty"),
        ({"sensor": None}, "missing_sensor"),
        ({"protocol": "ftp"}, "protocol_value"),
        ({"dst_port": 65536}, "dst_port_range"),
        ({"src_port": "12.5"}, "src_port_range"),
        ({"duration": -0.1}, "duration_value"),
        ({"kexAlgs": "a"}, "kexAlgs_list"),
    ],
)
def test_rejected(spark, tmp_path, event, rule):
    path = land(tmp_path, [BASE | event])
    assert V.check_events(logs.scan_events(spark, path)).first()["failed_rules"] == [rule]


def test_split_counts_and_malformed_lines(spark, tmp_path):
    events = [BASE | {"session": f"s{i}"} for i in range(50)]
    path = land(tmp_path, [*events, {"eventid": "cowrie.x"}, {}, "{broken", "", "  "])
    good_rows, bad = V.split_events(logs.scan_events(spark, path))
    assert good_rows.count() == 50
    assert sorted(r[0][0] for r in bad.select("failed_rules").collect()) == [
        "missing_eventid", "missing_timestamp", "not_json",
    ]
    with pytest.raises(Exception, match="not JSON"):
        logs.scan_events(spark, path, strict=True).collect()


def test_conform_types_and_given_enrichment(spark, tmp_path):
    event = BASE | {
        "eventid": "cowrie.session.closed", "duration": "0.3", "src_port": "22", "country": "DE", "asn": 24940,
        "asn_org": "O", "fluent_host": "pi", "fluent_source": "tail", "ttylog": "x",
    }
    row = V.conform(V.strip_transport(logs.scan_events(spark, land(tmp_path, [event])))).first().asDict()
    assert (row["duration"], row["src_port"], row["ts_us"]) == (0.3, 22, 1778115301950000)
    assert (row["given_country"], row["given_asn"], row["given_asn_org"]) == ("DE", 24940, "O")
    assert row["ts"] == event["timestamp"] and "fluent_host" not in row and "ttylog" not in row
    assert row["ingest_id"].startswith("sha1:") and len(row["ingest_id"]) == 45


def test_proxy_scan(spark, tmp_path, rows):
    rec = {"time": "2026-05-07T00:55:01.948594Z", "client_ip": "198.51.100.7", "client_port": 8728, "frontend_port": 22}
    lines = [
        rec,
        rec | {"time": "2026-05-07T00:55:01.948594+00:00", "frontend_port": 0, "duration": "+5", "status": "cD"},
        {k: v for k, v in rec.items() if k != "client_ip"},
        rec | {"time": "bad"},
        rec | {"client_port": "1_0"},
        rec | {"duration": None},
    ]
    got = rows(logs.scan_proxy(spark, land(tmp_path, lines)), "ts", "frontend_port", "duration", "status")
    ts = "2026-05-07T00:55:01.948594+00:00"
    assert got == [(ts, 0, 5, "cD"), (ts, 22, 0, ""), (ts, 22, 0, "")]


def test_proxy_text_scan(spark, tmp_path, rows):
    line = (
        "2026-05-07T00:55:01.948594+00:00 host haproxy[12345]: client={}:8728 frontend_port=22 duration=+0 "
        "bytes_uploaded=+0 bytes_downloaded=-1 status=cD"
    )
    path = land(tmp_path, [line.format("198.51.100.7"), line.format("2001:db8::1"), "noise"])
    got = rows(logs.scan_proxy(spark, path, text=True), "client_ip", "client_port", "duration", "bytes_downloaded")
    assert got == [("198.51.100.7", 8728, 0, -1)]


def test_routing_and_audit(spark, tmp_path, rows):
    land(tmp_path, [BASE, BASE, BASE | {"sensor": ""}, "{"], "raw", "cowrie", "date=2026-05-07", "host=pi")
    rec = {"time": "2026-05-07T00:55:01Z", "client_ip": "198.51.100.7", "client_port": 1, "frontend_port": 22}
    land(tmp_path, [rec, {"time": "x"}], "raw", "haproxy", "date=2026-05-07", "host=edge")
    land(tmp_path, [BASE], "raw", "2026", "05")
    lines = logs.read_lines(spark, str(tmp_path / "raw"))
    routed = logs.route_sources(lines).groupBy("kind", "date", "host").count()
    assert rows(routed) == [
        ("event", "2026-05-07", "pi", 4), ("event", None, None, 1), ("proxy", "2026-05-07", "edge", 2),
    ]
    total = logs.ingest_audit(lines).filter("object_path = '*'").first()
    assert (total["objects"], total["lines"], total["validated"], total["written"], total["errors"]) == (3, 7, 4, 3, 3)


def test_json_logs_keep_broken_lines(spark, tmp_path):
    path = land(tmp_path, [{"event_type": "alert", "alert": {"severity": 1}}, "oops"])
    got = logs.scan_json_logs(spark, path, "event_type STRING, alert STRUCT<severity: INT>").orderBy("event_type").collect()
    assert got[0]["json_error"] == "oops" and got[1]["alert"]["severity"] == 1


def test_dimension_loads(spark, tmp_path, rows):
    words = tmp_path / "words.txt"
    words.write_text("# head\n\n  padded  \nabc\nabc\nAbc\n#no\n")
    assert rows(dims.load_dictionary(spark, str(words))) == [("Abc",), ("abc",), ("padded",)]
    pools = tmp_path / "pools.json"
    pools.write_text(
        json.dumps({"pools": [{"asn": 1, "asn_org": "A", "country": "DE", "weight": 2, "cidrs": ["192.0.2.0/24", "bad"]}]}, indent=1)
    )
    assert rows(dims.load_geo_ranges(spark, str(pools))) == [(3221225984, 3221226239, "DE", 1, "A")]


def test_feed_scans(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('# comment\n"1","http://bad.example/x"\n')
    (tmp_path / "b.txt").write_text("# list\n203.0.113.9\n203.0.113.10 # note\nnot an ip\n999.1.1.1\n")
    feed = {"Event": {"id": "7", "info": "C2", "threat_level_id": "1", "Attribute": [{"type": "ip-dst", "value": "203.0.113.5"}]}}
    (tmp_path / "c.json").write_text(json.dumps(feed))
    csv = dims.scan_csv_feed(spark, str(tmp_path / "a.csv"), "urls", columns="id STRING, url STRING", value="url", kind="url")
    assert rows(csv, "kind", "value", "feed", "tag") == [("url", "http://bad.example/x", "urls", "tlp:white")]
    assert rows(dims.scan_text_feed(spark, str(tmp_path / "b.txt"), "list"), "value") == [("203.0.113.10",), ("203.0.113.9",)]
    assert rows(dims.scan_json_feed(spark, str(tmp_path / "c.json"), "osint"), "kind", "value", "indicator_event_id", "threat_level") == [
        ("ip", "203.0.113.5", "7", 1)
    ]


def test_event_sink_is_idempotent_and_last_write_wins(spark, tmp_path, rows):
    path = str(tmp_path / "store")
    first = spark.createDataFrame(
        [("s", "2026-05-07T00:00:00.0Z", "e", "a", 1), ("s", "2026-05-08T00:00:00.0Z", "e", "b", 1)],
        "session string, ts string, eventid string, v string, n int",
    )
    sinks.sink_events(first, path)
    sinks.sink_events(first, path)
    assert event_store(spark, path).read().count() == 2
    again = spark.createDataFrame(
        [("s", "2026-05-08T00:00:00.0Z", "e", "old", 1), ("s", "2026-05-08T00:00:00.0Z", "e", "new", 2)], first.schema
    )
    sinks.sink_events(again, path, arrival="n")
    assert rows(event_store(spark, path).read(), "ts", "v") == [("2026-05-07T00:00:00.0Z", "a"), ("2026-05-08T00:00:00.0Z", "new")]


def test_export_is_sorted_complete_and_checksummed(spark, tmp_path):
    df = spark.range(500).select(
        F.concat(F.lit("2026-05-0"), (F.col("id") % 3 + 1).cast("string"), F.lit("T0"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("ts"),
        F.col("id").cast("string").alias("session"),
    )
    one = {r["day"]: tuple(r) for r in sinks.export_partitioned(df, str(tmp_path / "x"), ("ts", "session")).collect()}
    two = {r["day"]: tuple(r) for r in sinks.export_partitioned(df.repartition(7), str(tmp_path / "y"), ("ts", "session")).collect()}
    assert len(one) == 3 and sum(r[1] for r in one.values()) == 500 and one == two
    by_hour = sinks.export_partitioned(df, str(tmp_path / "z"), ("ts",), by="hour")
    assert by_hour.count() == df.select(F.substring("ts", 1, 13)).distinct().count()


def test_retention(spark):
    now = 1778115301950000
    df = spark.createDataFrame([(now - sinks.RETENTION_US["rank"],), (now - sinks.RETENTION_US["rank"] + 1,)], "t bigint")
    assert sinks.retained(df, "rank", "t", now).count() == 1


def test_public_projection_has_no_private_column(spark):
    df = spark.createDataFrame([("e", "s", "p", "raw")], "eventid string, session string, password string, password_raw string")
    out = P.public_events(df)
    assert out.columns == list(PUBLIC_COLUMNS) and len(PUBLIC_COLUMNS) == 20 and "password_raw" not in out.columns


def test_sanitize(spark):
    df = spark.createDataFrame(
        [("192.0.2.1", "DE", 1, "O", "x", "f"), ("192.0.2.2", None, None, None, "x", "f")],
        "src_ip string, country string, asn bigint, asn_org string, password_raw string, fluent_host string",
    )
    out = P.sanitize(df, "192.0.2.1").orderBy("src_ip").collect()
    assert [tuple(r) for r in out] == [("192.0.2.2", None, None, None), ("203.0.113.1", "XX", 0, "TEST")]


def test_leak_audit(spark, rows):
    df = spark.createDataFrame([("a password_raw b", 60_000_000), ("ok", 60_000_000), ("hunter2", 125_000_000)], "t string, us bigint")
    assert rows(P.leak_audit(df, "t", "us", ["password_raw", "hunter2"])) == [
        ("1970-01-01T00:01", 1, True), ("1970-01-01T00:02", 1, True),
    ]
