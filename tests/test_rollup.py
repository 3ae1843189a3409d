import itertools
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from duskwatch.operators import rank as K
from duskwatch.operators import reports as R
from duskwatch.operators import rollup as A
from duskwatch.operators import triage as G
from duskwatch.operators.wordlist import expand_wordlist

NOW = datetime(2026, 5, 7, 12, 30)
COLS = (
    "eventid string, session string, ts string, src_ip string, username string, password string, country string, "
    "asn bigint, input string, dst_port int, duration double"
)


def ev(eventid, session="s", ts="2026-05-07T12:00:00.000000Z", src_ip="192.0.2.1", **kw):
    names = ("username", "password", "country", "asn", "input", "dst_port", "duration")
    return ("cowrie." + eventid, session, ts, src_ip, *[kw.get(n) for n in names])


def frame(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_one_login_gives_five_counters(spark, rows):
    e = frame(spark, [ev("login.failed", username="root", password="x", country="DE", asn=24940)] * 50)
    got = rows(A.hourly_counts(e), "dimension", "value", "count")
    assert got == [
        ("asn", "24940", 50), ("country", "DE", 50), ("eventid", "cowrie.login.failed", 50), ("password", "x", 50),
        ("username", "root", 50),
    ]


def test_commands_and_ports(spark, rows):
    lines = ["whoami", " whoami now", "uname -a", "", "   ", None]
    e = frame(
        spark,
        [ev("command.input", input=x) for x in lines]
        + [ev("login.failed", input="id", dst_port=22)]
        + [ev("direct-tcpip.request", dst_port=3478), ev("direct-tcpip.data", dst_port=3478), ev("direct-tcpip.request", dst_port=1080)]
        + [ev("direct-tcpip.request")],
    )
    assert rows(A.command_counts(e), "value", "count") == [("uname", 1), ("whoami", 2)]
    assert rows(A.proxy_port_counts(e), "value", "count") == [("1080", 1), ("3478", 2)]


def expected_label(duration, failed, success, usernames):
    logins = failed + success
    if logins and usernames > 9:
        return "credential_stuffing"
    if usernames == 1 and failed > 4:
        return "brute_force"
    return "scanner" if not logins and duration < 2 else "other"


def test_technique_labels_around_each_threshold(spark):
    grid = list(itertools.product((1.9, 2.0, 2.1), (0, 1, 4, 5, 6), (0, 1), (0, 1, 2, 9, 10, 11)))
    df = spark.createDataFrame(grid, "duration double, failed int, success int, usernames int")
    label = A.technique_label(*[F.col(c) for c in df.columns]).alias("label")
    assert {tuple(r)[:4]: r["label"] for r in df.select("*", label).collect()} == {g: expected_label(*g) for g in grid}


def test_session_summary_and_technique_hour(spark, rows):
    e = frame(
        spark,
        [ev("login.failed", username=f"u{i % 11}") for i in range(22)]
        + [ev("session.closed", ts="2026-05-07T13:00:00.000000Z", duration=None), ev("session.closed", session="t", duration=1.0)]
        + [ev("command.input", username="not-a-login"), ev("session.closed", session="", duration=1.0)],
    )
    assert rows(A.session_techniques(e), "session", "duration_seconds", "login_failed_count", "unique_usernames", "command_count", "technique") == [
        ("s", 0.0, 22, 11, 1, "credential_stuffing"), ("t", 1.0, 0, 0, 0, "scanner"),
    ]
    assert rows(A.technique_hourly(e)) == [
        ("2026-05-07T12", "technique", "scanner", 1), ("2026-05-07T13", "technique", "credential_stuffing", 1),
    ]


def counter(bucket, dimension, value, count):
    return (bucket, dimension, value, count)


COUNTER = "bucket string, dimension string, value string, count bigint"


def test_trailing_windows_include_the_current_hour(spark, rows):
    c = spark.createDataFrame(
        [
            counter("2026-05-07T12", "username", "now", 1), counter("2026-05-06T13", "username", "edge", 2),
            counter("2026-05-06T12", "username", "out", 4), counter("2026-04-30T13", "username", "week", 8),
            counter("2026-04-30T12", "username", "gone", 16), counter("2026-05-07T13", "username", "future", 1),
            counter("2026-05-07T12", "username", None, 32),
        ],
        COUNTER,
    )
    assert rows(A.trailing_totals(c, NOW), "window", "value", "count") == [
        ("24H", "edge", 2), ("24H", "now", 1), ("7D", "edge", 2), ("7D", "now", 1), ("7D", "out", 4), ("7D", "week", 8),
    ]


def totals(spark, counts):
    data = [("24H", "username", v, n) for v, n in counts.items()]
    return spark.createDataFrame(data, "window string, dimension string, value string, count bigint")


def ranked(spark, counts):
    return [(r["value"], r["count"]) for r in K.top_ranks(totals(spark, counts)).orderBy("rank").collect()]


@pytest.mark.parametrize("seed", [3, 4])
def test_ranks_equal_a_plain_sort(spark, seed):
    rng = random.Random(seed)
    counts = {"".join(rng.choices("aAbé", k=4)): rng.randrange(1, 12) for _ in range(70)}
    want = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0].encode()))[:25]
    assert ranked(spark, counts) == want
    assert ranked(spark, dict(reversed(counts.items()))) == want


def test_rank_key_orders_like_the_rank(spark):
    df = spark.createDataFrame([(5, "b"), (5, "a"), (1000, "z")], "n bigint, v string")
    keys = sorted(r[0] for r in df.select(K.rank_key(F.col("n"), F.col("v"))).collect())
    assert keys == ["9999998999#z", "9999999994#a", "9999999994#b"]


def test_daily_summary(spark, rows):
    e = frame(
        spark,
        [ev("login.failed", src_ip="192.0.2.1"), ev("login.success", session="t", src_ip="192.0.2.2"), ev("session.file_download", session="", src_ip="192.0.2.2")],
    )
    tech = spark.createDataFrame([counter("2026-05-07T01", "technique", "brute_force", 3), counter("2026-05-07T02", "technique", "brute_force", 4), counter("2026-05-06T02", "technique", "other", 1)], COUNTER)
    row = A.daily_summary(e, tech, day="2026-05-07").first().asDict()
    assert row == {"day": "2026-05-07", "total_events": 3, "unique_ips": 2, "unique_sessions": 2, "successful_logins": 1, "file_downloads": 1, "techniques": {"brute_force": 7}}
    empty = A.daily_summary(e, tech, day="2026-05-01").first().asDict()
    assert empty["total_events"] == 0 and empty["techniques"] == {}


def test_breakdown_sums_each_span(spark):
    rng = random.Random(8)
    names = [*A.TECHNIQUES, "odd"]
    data = [counter(f"2026-05-{d:02d}T{rng.randrange(24):02d}", "technique", rng.choice(names), rng.randrange(1, 50)) for d in range(1, 8) for _ in range(9)]
    table = spark.createDataFrame(data, COUNTER)
    for row in A.technique_breakdowns(table, NOW, {"day": 24, "week": 168}).collect():
        first = "2026-05-06T13" if row["span"] == "day" else "2026-04-30T13"
        for t in A.TECHNIQUES:
            assert row[t] == sum(n for b, _, v, n in data if v == t and first <= b <= "2026-05-07T12")
    assert A.technique_breakdown(table.limit(0), NOW).first()["other"] == 0


def test_timelines(spark):
    c = spark.createDataFrame([counter("2026-05-07T12", "eventid", "a", 2), counter("2026-05-07T12", "eventid", "b", 3), counter("2026-05-06T12", "eventid", "a", 9)], COUNTER)
    hours = R.timeline_hourly(c, NOW, "24h", unavailable=["2026-05-07T11"]).orderBy("ts").collect()
    assert len(hours) == 24 and hours[-1]["ts"] == "2026-05-07T12:00:00Z" and hours[-1]["count"] == 5
    assert hours[-2]["count"] is None and hours[0]["count"] == 0
    days = R.timeline_daily(spark.createDataFrame([("2026-05-06", 7)], "day string, total_events bigint"), NOW, "7d").orderBy("ts").collect()
    assert [r["count"] for r in days] == [0, 0, 0, 0, 0, 7, 0]


def test_paging_covers_everything_once(spark):
    e = frame(spark, [ev("x", session=f"s{i}", ts="2026-05-07T00:00:0%d.000000Z" % (i // 3)) for i in range(8)])
    seen, before = [], None
    while True:
        page = R.events_page(e, "2026-05-07", 3, before).orderBy(F.desc("ts"), F.desc("session")).collect()
        seen += [r["session"] for r in page]
        if not page or page[0]["next_before"] is None:
            break
        last = page[-1]
        before = (last["ts"], last["session"], last["eventid"])
    assert sorted(seen) == [f"s{i}" for i in range(8)] and len(seen) == 8


@pytest.mark.parametrize("limit", [0, 201])
def test_limits_are_checked(spark, limit):
    e = frame(spark, [ev("x")])
    with pytest.raises(ValueError):
        R.events_page(e, "2026-05-07", limit)
    with pytest.raises(ValueError):
        R.timeline_hourly(e, NOW, "2h")
    with pytest.raises(ValueError):
        R.session_log(e, "")


def test_top_asns_and_map(spark, rows):
    ranks = spark.createDataFrame([("24H", "asn", "1", 5, 1), ("24H", "asn", "x", 4, 2), ("24H", "country", "de", 8, 1), ("24H", "country", "ZZ", 99, 2), ("24H", "country", "FR", 4, 3)], "window string, dimension string, value string, count bigint, rank int")
    assert rows(R.top_asns(ranks)) == [(1, 1, None, 5)]
    orgs = spark.createDataFrame([(1, "One")], "asn bigint, asn_org string")
    assert rows(R.top_asns(ranks, organisations=orgs)) == [(1, 1, "One", 5)]
    codes = spark.createDataFrame([("DE", "276", "Germany"), ("FR", "250", "France")], "alpha2 string, numeric string, name string")
    got = rows(K.relative_intensity(R.top_list(ranks, "country"), codes), "alpha2", "count", "max_count", "countries", "intensity")
    assert got == [("DE", 8, 8, 2, 1.0), ("FR", 4, 8, 2, 0.5)]
    assert R.observed_countries(ranks).first()[0] == 3


def test_summary_modes(spark):
    e = frame(spark, [ev("x", ts="2026-05-07T12:00:00.000000Z"), ev("x", ts="2026-05-06T20:00:00.000000Z", src_ip="192.0.2.9"), ev("x", ts="2026-05-06T12:00:00.000000Z")])
    ref, true = (R.summary_card(e, NOW, m).first().asDict() for m in ("ref", "true"))
    assert (ref["total"], ref["last_24h"], ref["last_1h"], ref["unique_ips_24h"]) == (1, 1, 0, 1)
    assert (true["total"], true["last_24h"], true["last_1h"], true["unique_ips_24h"]) == (1, 2, 1, 2)


def test_heartbeat_gaps_and_alarms(spark, rows):
    start, end = datetime(2026, 5, 7), datetime(2026, 5, 7, 1)
    us = G.to_us(start)
    r = spark.createDataFrame([("a", us), ("a", us + 46 * 60_000_000), ("b", us - 1)], "s string, ts_us bigint")
    gaps = rows(G.heartbeat_gaps(r, "s", start, end))
    assert gaps == [("a", us + i * 900_000_000) for i in (1, 2)] + [("b", us + i * 900_000_000) for i in range(4)]
    m = spark.createDataFrame([("x", us, 10.0), ("x", us + 1, 20.0), ("x", us + 300_000_000, 30.0)], "series string, ts_us bigint, value double")
    span = {"period_s": 300, "start": start, "end": datetime(2026, 5, 7, 0, 20)}

    def alarm(**kw):
        return [r["alarm"] for r in G.evaluate_alarm(m, **kw, **span).orderBy("period_us").collect()]

    assert alarm(statistic="sum", threshold=29, comparison=">", periods=1) == [True, True, False, False]
    assert alarm(statistic="p95", threshold=15, comparison=">", periods=2) == [False, True, False, False]
    assert alarm(statistic="sum", threshold=1, comparison="<", periods=1, missing="breaching") == [False, False, True, True]


def test_coverage_and_rule_stats(spark, rows):
    cat = spark.createDataFrame([("T", "a"), ("T", "b"), ("U", "c"), ("V", "d")], "tactic string, technique string")
    rules = spark.createDataFrame([("1", "a"), ("2", None), ("3", "d")], "rule_id string, technique string")
    assert rows(G.coverage_gaps(cat, rules)) == [("T", "b", "partial"), ("U", "c", "none")]
    alerts = spark.createDataFrame([("r", str(i)) for i in range(10)] + [("q", "0")], "rule_id string, source_event string")
    labels = spark.createDataFrame([(str(i), i < 7) for i in range(10)], "source_event string, true_positive boolean")
    assert rows(G.rule_stats(alerts, labels)) == [("q", 1, 1, 0, 1.0, "STABLE"), ("r", 10, 7, 3, 0.7, "STABLE")]


def test_wordlist(spark):
    out = {r[0] for r in expand_wordlist(spark.createDataFrame([("pass",), ("root",), ("",)], "word string"), ["root", "pass"]).collect()}
    assert {"pass", "Pass", "pass1", "pass@123", "Pass123!@#", "pass2026", "pass@2020", "p@ss", "P@Ss", "pa$$", "p@$$!", "r00t", "root_pass", "passroot", "pass/pass", "rootroot"} <= out
    assert "" not in out and "root__pass" not in out
