import pytest
from pyspark.sql import functions as F

from duskwatch.operators import rules as D
from duskwatch.operators import triage as G
from duskwatch.operators.joins import either_endpoint_join

SEC = 1_000_000
T = 1778115301950000
FAILED = "cowrie.login.failed"


def honeypot(spark, rows):
    """rows: (eventid, ip, t, username, input, url)"""
    data = [(f"hp:{i:03d}", *r) for i, r in enumerate(rows)]
    return spark.createDataFrame(
        data, "source_event string, eventid string, src_ip string, ts_us bigint, username string, input string, url string"
    )


def ids_of(df):
    return sorted(r["rule_id"] for r in df.select("rule_id").collect())


def logins(spark, n, step, users):
    return honeypot(spark, [(FAILED, "192.0.2.1", T + int(i * step * SEC), f"u{i % users}", None, None) for i in range(n)])


def test_brute_force_scenario(spark):
    e = logins(spark, 6, 1, 1)
    assert ids_of(D.apply_rules(e, "honeypot")) == ["100100"] * 6 + ["100101"] * 6
    hits = D.brute_force(e).orderBy("ts_us").collect()
    assert [r["n_events"] for r in hits] == [5, 6]
    assert D.brute_force(e, first_only=True).count() == 1


def test_stuffing_scenario(spark):
    e = logins(spark, 11, 0.5, 11)
    assert [r["n_distinct"] for r in D.credential_stuffing(e).orderBy("ts_us").collect()] == [10, 11]
    assert D.brute_force(e).count() == 7
    assert D.credential_stuffing(e, usernames=3, failures=5, within_us=300 * SEC).count() == 7


@pytest.mark.parametrize("gap, alerts", [(300 * SEC, 1), (300 * SEC + 1, 0)])
def test_interval_is_closed_at_five_minutes(spark, gap, alerts):
    times = [T, T + 1, T + 2, T + 3, T + gap]
    e = honeypot(spark, [(FAILED, "192.0.2.1", t, "u", None, None) for t in times])
    assert D.brute_force(e).count() == alerts


def test_sources_are_kept_apart(spark):
    rows = [(FAILED, f"192.0.2.{i % 2}", T + i, "u", None, None) for i in range(8)]
    assert D.brute_force(honeypot(spark, rows)).count() == 0


def test_single_event_rules_and_details(spark, rows):
    e = honeypot(
        spark,
        [
            ("cowrie.login.success", "192.0.2.1", T, "root", None, None),
            ("cowrie.command.input", "192.0.2.1", T, None, "id", None),
            ("cowrie.session.file_download", "192.0.2.1", T, None, None, "http://x"),
            ("other.event", "192.0.2.1", T, None, None, None),
        ],
    )
    got = rows(D.apply_rules(e, "honeypot").filter("depth = 1"), "rule_id", "level", "technique", "detail")
    assert got == [
        ("100102", 10, "T1078", "Successful login from 192.0.2.1, user root"),
        ("100103", 8, "T1059", "Command run: id"),
        ("100104", 10, "T1105", "Payload download: http://x"),
    ]
    for key in ("d1", "d2", "d3", "d4", "d5"):
        one = sorted(map(str, D.apply_rule(e, key).collect()))
        rule = D.BY_KEY[key].rule_id
        assert one == sorted(map(str, D.apply_rules(e, "honeypot").filter(F.col("rule_id") == rule).collect()))


def test_ids_rules(spark):
    data = [("a", "alert", 1, "ET MALWARE x"), ("b", "alert", 2, "ET SCAN y"), ("c", "flow", 1, "ET SCAN z")]
    df = spark.createDataFrame(
        [(f"ids:{s}", "192.0.2.1", T, e, n, sig) for s, e, n, sig in data],
        "source_event string, src_ip string, ts_us bigint, event_type string, severity int, signature string",
    )
    alerts = D.apply_rules(df, "ids")
    assert ids_of(alerts) == ["100200", "100200", "100201", "100202", "100203"]
    final = {r["source_event"]: r["rule_id"] for r in D.final_alerts(alerts).collect()}
    assert final == {"ids:a": "100201", "ids:b": "100203"}


def flow(i, direction, src, dst, port, sent=0, share=None, hour=12):
    return (f"flow:{i}", i, T, hour, direction, src, dst, port, sent, share, "svc")


FLOW = (
    "source_event string, flow_id bigint, ts_us bigint, ts_hour bigint, direction string, src_ip string, "
    "dest_ip string, dest_port int, bytes_sent bigint, smb_share string, smb_username string"
)
HOME, OUT = "10.0.0.5", "203.0.113.5"


@pytest.mark.parametrize(
    "row, rules",
    [
        (("outbound", HOME, OUT, 4444), ["1000010", "unusual_outbound_port"]),
        (("outbound", HOME, OUT, 6666), ["unusual_outbound_port"]),
        (("inbound", OUT, HOME, 6667), []),
        (("inbound", OUT, HOME, 2222), ["1000002"]),
        (("inbound", HOME, HOME, 2222), []),
        (("inbound", OUT, HOME, 23), ["1000003"]),
        (("outbound", HOME, OUT, 443, 10485760), []),
        (("outbound", HOME, OUT, 443, 10485761), ["1000030"]),
    ],
)
def test_flow_rules(spark, row, rules):
    df = spark.createDataFrame([flow(1, *row)], FLOW)
    assert ids_of(D.apply_rules(df, "flows")) == rules


@pytest.mark.parametrize("hour, hit", [(21, False), (22, True), (23, True), (0, True), (5, True), (6, False)])
@pytest.mark.parametrize("share", ["\\\\h\\C$", "\\\\h\\ADMIN$", "\\\\h\\IPC$"])
def test_admin_share_hours(spark, hour, hit, share):
    df = spark.createDataFrame([flow(1, "internal", HOME, HOME, 445, 0, share, hour)], FLOW)
    assert ids_of(D.apply_rules(df, "flows")) == (["smb_admin_share"] if hit else [])
    other = spark.createDataFrame([flow(1, "internal", HOME, HOME, 445, 0, "\\\\h\\Docs", hour)], FLOW)
    assert D.apply_rules(other, "flows").count() == 0


def test_dns_rule(spark):
    names = ["a" * 20 + ".com", "A1" * 12 + ".info", "a" * 19 + ".com", "a" * 20 + ".museum", "x." + "a" * 20 + ".com"]
    df = spark.createDataFrame(
        [(f"dns:{i}", HOME, T, n) for i, n in enumerate(names)], "source_event string, src_ip string, ts_us bigint, dns_name string"
    )
    assert sorted(r[0] for r in D.apply_rules(df, "dns").select("source_event").collect()) == ["dns:0", "dns:1"]


def test_indicator_match_on_either_side_once(spark, rows):
    flows = spark.createDataFrame(
        [flow(1, "o", HOME, OUT, 1), flow(2, "i", OUT, HOME, 1), flow(3, "x", OUT, OUT, 1), flow(4, "x", HOME, HOME, 1)], FLOW
    )
    ind = spark.createDataFrame(
        [(OUT, "7", 1, "C2"), (OUT, "8", 2, "x")], "value string, indicator_event_id string, threat_level int, info string"
    )
    hits = either_endpoint_join(flows, ind)
    assert rows(hits, "flow_id", "indicator_event_id", "matched_on") == [
        (1, "7", "dest"), (1, "8", "dest"), (2, "7", "src"), (2, "8", "src"), (3, "7", "src"), (3, "8", "src"),
    ]
    assert ids_of(D.apply_rules(hits, "ioc")) == ["100300"] * 6 + ["100301"] * 3


def test_threshold_suppression(spark, rows):
    m = spark.createDataFrame([("a", 60 * SEC + i) for i in range(9)] + [("b", i * 15 * SEC) for i in range(5)], "src_ip string, ts_us bigint")
    assert rows(D.threshold_both(m), "src_ip", "window_us", "matches") == [("a", 60 * SEC, 9)]


@pytest.mark.parametrize("lookback, n", [(None, 2), (10, 1), (9, 0)])
def test_cross_source(spark, lookback, n):
    fails = spark.createDataFrame([("a", T), ("c", T + 5)], "src_ip string, ts_us bigint")
    alerts = spark.createDataFrame(
        [("a", T), ("a", T + 10), ("a", T + 100), ("b", T + 10), ("c", T + 4)], "src_ip string, ts_us bigint"
    )
    assert D.cross_source(alerts, fails, lookback_us=lookback).count() == n


def test_final_alert_prefers_children_then_level(spark):
    cols = "source_event string, src_ip string, ts_us bigint, rule_id string, level bigint, technique string, depth bigint, detail string"
    data = [("e", "i", 1, "base", 15, None, 0, ""), ("e", "i", 1, "low", 5, None, 1, ""), ("e", "i", 1, "high", 8, None, 1, "")]
    assert D.final_alerts(spark.createDataFrame(data, cols)).first()["rule_id"] == "high"


def test_final_alerts_sort_after_the_shuffle(spark, rows):
    e = honeypot(spark, [(FAILED, "a", T, "u", None, None), ("cowrie.login.success", "b", T, "u", None, None), ("other", "c", T, "u", None, None)])
    f = spark.createDataFrame([flow(i, d, *ends, p, 20_000_000, "\\C$", 23) for i, (d, ends, p) in enumerate([("outbound", (HOME, OUT), 4444), ("inbound", (OUT, HOME), 23), ("inbound", (OUT, HOME), 22)])], FLOW)
    for df, source in ((e, "honeypot"), (f, "flows")):
        every, best = D.apply_rules(df, source), D.apply_rules(df, source, best=True)
        assert rows(D.final_alerts(best)) == rows(D.final_alerts(every))
        assert best.count() == best.select("source_event").distinct().count() <= every.count()
        plan = D.final_alerts(every)._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan.partition("Exchange")[2] and "WindowGroupLimit" not in plan.partition("Exchange")[2]


def test_flows_are_spread_before_they_meet_indicators(spark):
    f = spark.createDataFrame([flow(i, "outbound", HOME, OUT, 22) for i in range(40)], FLOW).coalesce(1)
    ind = spark.createDataFrame([(OUT, "m1"), (OUT, "m2")], "value string, indicator_event_id string")
    pairs = either_endpoint_join(f, ind)
    assert pairs.count() == 80
    assert pairs.filter("matched_on = 'dest'").groupBy("flow_id").count().filter("count = 2").count() == 40
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert f", {tasks}), REPARTITION_BY_NUM" in plan


def test_triage(spark):
    e = honeypot(spark, [(FAILED, "a", T, "u", None, None), ("cowrie.login.success", "b", T, "u", None, None), (FAILED, "c", T, "u", None, None)])
    ips = spark.createDataFrame([("c",)], "src_ip string")
    none = ips.filter("false")
    ind = ips.withColumnRenamed("src_ip", "value")
    got = {r["src_ip"]: (r["known_bad"], r["logged_in"], r["escalate"]) for r in G.attacker_triage(e, ind, none, none).collect()}
    assert got == {"a": (False, False, False), "b": (False, True, True), "c": (True, False, True)}


def test_fanout_window(spark, rows):
    day = 86_400 * SEC
    f = spark.createDataFrame([flow(i, "x", HOME, f"10.0.0.{d}", 445, 0, s) for i, (d, s) in enumerate([(1, "\\C$"), (2, "\\C$"), (2, "\\IPC$"), (3, "\\Docs")])], FLOW)
    assert rows(G.lateral_fanout(f, T + day)) == [(HOME, 2, 3)]
    assert rows(G.lateral_fanout(f, T + 8 * day)) == []
