import random

import pytest
from pyspark.sql import functions as F

from duskwatch.operators import correlate as C
from duskwatch.operators import joins, sweep
from duskwatch.operators.enrich import classify_passwords, geo_enrich

T = 1778115301950000  # 2026-05-07T00:55:01.950
LOOP = "127.0.0.1"
GEO = [(3325256704, 3325256959, "DE", 1, "One"), (3405803776, 3405804031, "FR", 2, "Two")]  # 198.51.100/24, 203.0.113/24


def events(spark, rows):
    """rows: (session, ts_us, src_ip)"""
    data = [(s, t, ip, f"e{i:03d}", str(t)) for i, (s, t, ip) in enumerate(rows)]
    return spark.createDataFrame(data, "session string, ts_us bigint, src_ip string, eventid string, ts string")


def proxies(spark, rows):
    return spark.createDataFrame(rows, "ts_us bigint, client_ip string")


def geo(spark):
    return spark.createDataFrame(GEO, "lo bigint, hi bigint, country string, asn bigint, asn_org string")


def forward(e, p, **span):
    return C.correlate_forward(e, p, list_candidates=True, **span)


def result(df):
    cols = ("eventid", "src_ip", "correlation_status", "correlation_candidate_count", "correlation_candidate_ips")
    return [tuple(r)[1:] for r in df.orderBy("eventid").select(*cols).collect()]


def test_forward_outcomes(spark):
    e = events(spark, [("a", T, LOOP), ("b", T + 10_000_000, LOOP), ("c", T + 20_000_000, LOOP), ("d", T, "91.92.93.94")])
    p = proxies(
        spark, [(T - 50_000, "198.51.100.7"), (T + 19_950_000, "198.51.100.8"), (T + 19_960_000, "198.51.100.9")]
    )
    assert result(forward(e, p)) == [
        ("198.51.100.7", "matched", 1, ["198.51.100.7"]),
        (LOOP, "missed", 0, []),
        (LOOP, "ambiguous", 2, ["198.51.100.8", "198.51.100.9"]),
        ("91.92.93.94", None, None, None),
    ]


@pytest.mark.parametrize("delta, status", [(1_000, "matched"), (999, "missed"), (500_000, "matched"), (500_001, "missed")])
def test_forward_window_edges(spark, delta, status):
    got = result(forward(events(spark, [("a", T, LOOP)]), proxies(spark, [(T - delta, "198.51.100.7")])))
    assert got[0][1] == status


def test_empty_window_has_no_candidates(spark):
    e, p = events(spark, [("a", T, LOOP)]), proxies(spark, [(T - 1_000, "198.51.100.7")])
    assert result(forward(e, p, window_us=1_000, floor_us=1_000))[0][1] == "missed"


def test_two_proxy_rows_of_one_instant_are_ambiguous(spark):
    p = proxies(spark, [(T - 5_000, "198.51.100.7"), (T - 5_000, "198.51.100.7")])
    assert result(forward(events(spark, [("a", T, LOOP)]), p))[0][1:] == ("ambiguous", 2, ["198.51.100.7"] * 2)


def test_candidate_spans_and_lists_agree(spark):
    rnd = random.Random(11)
    times = [T + rnd.randrange(20_000_000) for _ in range(80)]
    clients = [(T + rnd.randrange(20_000_000), f"198.51.100.{i}") for i in range(120)]
    e, p = events(spark, [("a", t, LOOP) for t in times]), proxies(spark, clients)
    want = {}
    for t in times:
        inside = sorted(c for c in clients if t - 500_000 <= c[0] <= t - 1_000)
        if len(inside) > 1:
            want[t] = inside
    spans = {r["ts_us"]: (r["n"], r["oldest_us"], r["newest_us"]) for r in C.candidate_spans(e, p).collect()}
    assert spans == {t: (len(c), c[0][0], c[-1][0]) for t, c in want.items()} and want
    listed = {}
    for t, us, ip in C.candidates_of(e, p).collect():
        listed.setdefault(t, []).append((us, ip))
    assert {t: sorted(c) for t, c in listed.items()} == want
    column = forward(e, p).filter("correlation_status = 'ambiguous'").collect()
    assert {r["ts_us"]: r["correlation_candidate_ips"] for r in column} == {t: [ip for _, ip in c] for t, c in want.items()}


@pytest.mark.parametrize("hot_rows", [2, 10**9])
def test_inheritance(spark, hot_rows):
    e = events(
        spark,
        [
            ("a", T - 1_000_000, LOOP),  # before the match: keeps its own outcome
            ("a", T, LOOP),
            ("a", T + 30_000_000, LOOP),
            ("a", T + 60_000_000, LOOP),  # has a window match of its own, which is ignored
            ("a", T + 61_000_000, "91.92.93.94"),
            ("b", T + 90_000_000, LOOP),
        ],
    )
    p = proxies(spark, [(T - 50_000, "198.51.100.7"), (T + 59_900_000, "198.51.100.8")])
    got = result(C.inherit_matches(forward(e, p), hot_rows=hot_rows))
    assert [(r[0], r[1], r[2]) for r in got] == [
        (LOOP, "missed", 0),
        ("198.51.100.7", "matched", 1),
        ("198.51.100.7", "matched_inherited", 1),
        ("198.51.100.7", "matched_inherited", 1),
        ("91.92.93.94", None, None),
        (LOOP, "missed", 0),
    ]
    assert got[2][3] == ["198.51.100.7"]


def stored(spark, rows):
    """rows: (session, ts_us, src_ip, status)"""
    data = [
        (s, t, ip, f"e{i:03d}", str(t), st, None if st is None else int(st.startswith("matched")), [], None, None, None)
        for i, (s, t, ip, st) in enumerate(rows)
    ]
    return spark.createDataFrame(
        data,
        "session string, ts_us bigint, src_ip string, eventid string, ts string, correlation_status string, "
        "correlation_candidate_count bigint, correlation_candidate_ips array<string>, country string, asn bigint, "
        "asn_org string",
    )


@pytest.mark.parametrize("hot_rows", [1, 10**9])
def test_backward_match_updates_the_whole_session(spark, hot_rows):
    e = stored(
        spark,
        [
            ("a", T, LOOP, "missed"), ("a", T + 9_000_000, LOOP, "ambiguous"), ("a", T + 9_500_000, "203.0.113.4", "matched"),
            ("a", T + 9_600_000, "192.0.2.1", None), ("b", T + 50_000_000, LOOP, "missed"),
        ],
    )
    out = C.correlate_backward(
        e, proxies(spark, [(T - 10_000, "198.51.100.7")]), geo_ranges=geo(spark), hot_rows=hot_rows
    )
    got = [tuple(r) for r in out.orderBy("eventid").select("src_ip", "correlation_status", "correlation_candidate_count", "country").collect()]
    assert got == [
        ("198.51.100.7", "matched", 1, "DE"), ("198.51.100.7", "matched", 1, "DE"), ("203.0.113.4", "matched", 1, None),
        ("198.51.100.7", "matched", 1, "DE"), (LOOP, "missed", 0, None),
    ]


def test_backward_leaves_several_sessions_and_no_candidates_alone(spark):
    e = stored(spark, [("a", T, LOOP, "missed"), ("b", T + 1_000, LOOP, "missed"), ("c", T + 90_000_000, LOOP, "missed")])
    p = proxies(spark, [(T - 10_000, "198.51.100.7"), (T + 40_000_000, "198.51.100.8")])
    assert {r[1] for r in result(C.correlate_backward(e, p))} == {"missed"}


def test_backward_earliest_proxy_row_wins(spark):
    e = stored(spark, [("a", T, LOOP, "missed"), ("a", T + 5_000_000, LOOP, "missed")])
    p = proxies(spark, [(T + 4_900_000, "198.51.100.9"), (T - 10_000, "198.51.100.7")])
    assert {r[0] for r in result(C.correlate_backward(e, p))} == {"198.51.100.7"}


def test_resolve_runs_all_passes(spark):
    e = events(spark, [("a", T, LOOP), ("b", T + 60_000_000, LOOP), ("c", T + 90_000_000, "203.0.113.9")])
    early, late = proxies(spark, [(T - 5_000, "198.51.100.7")]), proxies(spark, [(T + 59_990_000, "203.0.113.4")])
    out = C.resolve(e, early, late, geo(spark), list_candidates=True).orderBy("eventid").collect()
    assert [(r["src_ip"], r["correlation_status"], r["country"]) for r in out] == [
        ("198.51.100.7", "matched", "DE"), ("203.0.113.4", "matched", "FR"), ("203.0.113.9", None, "FR"),
    ]


def brute_counts(points, probes, lo, hi):
    return [sum(t - hi <= p <= t - lo for p in points) for t in probes]


@pytest.mark.parametrize("seed", range(3))
def test_trailing_counts_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    points = [(rnd.choice("ab"), rnd.randrange(2_000)) for _ in range(300)]
    probes = [(rnd.choice("abc"), rnd.randrange(-50, 2_200)) for _ in range(300)]
    pts = spark.createDataFrame([(k, t, f"{t:05d}") for k, t in points], "k string, t bigint, v string")
    prb = spark.createDataFrame(probes, "k string, t bigint")
    for lo, hi, chunk in ((0, 90, None), (7, 100, 94), (1, 1, 5)):
        out = sweep.trailing_counts(pts, prb, keys=["k"], time="t", lo=lo, hi=hi, carry="v", chunk=chunk)
        for k, t, n, last in out.collect():
            inside = [p for key, p in points if key == k and t - hi <= p <= t - lo]
            assert n == len(inside) and last == (f"{max(inside):05d}" if inside else None)
        assert out.count() == len(probes)


@pytest.mark.parametrize("seed", range(3))
def test_self_counts_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    data = [(i, rnd.choice("ab"), rnd.randrange(800), rnd.choice(["u", "v", "w", "x", None])) for i in range(300)]
    df = spark.createDataFrame(data, "i int, k string, t bigint, u string")
    for hi in (0, 40, 2_000):
        out = {r["i"]: r for r in sweep.self_counts(df, key="k", value="u", time="t", hi=hi).collect()}
        plain = {r["i"]: r["n_events"] for r in sweep.self_counts(df, key="k", time="t", hi=hi).collect()}
        assert len(out) == len(plain) == len(data)
        for i, k, t, _ in data:
            inside = [u for _, kk, tt, u in data if kk == k and t - hi <= tt <= t]
            assert out[i]["n_events"] == plain[i] == len(inside)
            assert out[i]["n_distinct"] == len({u for u in inside if u})


@pytest.mark.parametrize("seed", range(3))
def test_single_owner_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    points = [(rnd.choice("abc"), rnd.randrange(3_000)) for _ in range(120)]
    probes = [rnd.randrange(-100, 3_100) for _ in range(200)]
    pts = spark.createDataFrame(points, "session string, t bigint")
    prb = spark.createDataFrame([(t,) for t in probes], "t bigint")
    out = {r["t"]: r for r in sweep.single_owner(pts, prb, owner="session", time="t", lo=5, hi=60).collect()}
    assert set(out) == set(probes)
    for p in probes:
        owners = {s for s, t in points if p + 5 <= t <= p + 60}
        assert out[p]["owners"] == min(len(owners), 2)
        assert out[p]["session"] == (owners.pop() if len(owners) == 1 else None)


def test_nearest_preceding_against_brute_force(spark):
    rnd = random.Random(5)
    points = [rnd.randrange(50_000) for _ in range(60)]
    probes = [(i, rnd.randrange(60_000)) for i in range(200)]
    pts = spark.createDataFrame([(t,) for t in points], "t bigint")
    out = sweep.nearest_preceding(
        spark.createDataFrame(probes, "i int, t bigint"), pts, time="t", floor_us=10, chunk=1_000
    )
    assert out.count() == len(probes)
    for _, t, got in out.collect():
        assert got == max((p for p in points if p <= t - 10), default=None)


def test_interval_join_against_brute_force(spark):
    rnd = random.Random(7)
    left, right = [(rnd.randrange(3_000),) for _ in range(150)], [(rnd.randrange(3_000),) for _ in range(150)]
    out = joins.interval_join(
        spark.createDataFrame(left, "a bigint"), spark.createDataFrame(right, "b bigint"),
        left_time="a", right_time="b", lo=3, hi=70,
    )
    want = sorted((a, b) for (a,) in left for (b,) in right if a - 70 <= b <= a - 3)
    assert sorted(tuple(r) for r in out.collect()) == want


def test_geo_lookup(spark):
    nested = geo(spark).unionByName(
        spark.createDataFrame([(3325256704 + 16, 3325256704 + 31, "AT", 9, "Nine")], geo(spark).schema)
    )
    ips = ["198.51.100.1", "198.51.100.20", "203.0.113.255", "192.0.2.1", "nonsense", "2001:db8::1", None]
    df = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "i int, src_ip string")
    out = [tuple(r)[2:] for r in geo_enrich(df, nested).orderBy("i").collect()]
    none = (None, None, None)
    assert out == [("DE", 1, "One"), ("AT", 9, "Nine"), ("FR", 2, "Two"), none, none, none, none]


def test_given_country_wins_with_its_own_asn(spark):
    df = spark.createDataFrame(
        [(0, "198.51.100.1", "US", None, None), (1, "198.51.100.1", None, 5, "x")],
        "i int, src_ip string, given_country string, given_asn bigint, given_asn_org string",
    )
    out = [tuple(r) for r in geo_enrich(df, geo(spark)).orderBy("i").select("country", "asn", "asn_org").collect()]
    assert out == [("US", None, None), ("DE", 1, "One")]


@pytest.mark.parametrize("seed", range(2))
def test_disjoint_ranges_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    ranges = []
    for i in range(40):
        lo = rnd.randrange(0, 300_000)
        ranges.append((lo, lo + rnd.choice([0, 3, 500, 70_000, 150_000]), f"r{i}"))
    flat = joins.disjoint_ranges(spark.createDataFrame(ranges, "lo bigint, hi bigint, name string")).collect()
    for _ in range(400):
        x = rnd.randrange(0, 460_000)
        want = min(((hi - lo, lo, n) for lo, hi, n in ranges if lo <= x <= hi), default=None)
        hit = [r["name"] for r in flat if r["lo"] <= x <= r["hi"]]
        assert hit == ([want[2]] if want else [])


def test_passwords(spark):
    words = spark.createDataFrame([("123456",), ("Admin",), ("0",)], "word string")
    values = ["123456", "admin", "Admin", "", None, "пароль😀"]
    df = spark.createDataFrame([(str(i), "t", v) for i, v in enumerate(values)], "session string, ts string, password string")
    out = [tuple(r) for r in classify_passwords(df, words).orderBy("session").select("password", "password_raw").collect()]
    assert out == [
        ("123456", None), ("<filtered:len=5>", "admin"), ("Admin", None), ("<filtered:len=0>", ""), (None, None),
        ("<filtered:len=7>", "пароль😀"),
    ]


@pytest.mark.parametrize("hot_rows", [1, 3, 10**9])
def test_lookup_keeps_every_row_however_hot_keys_are_split(spark, hot_rows):
    data = [("hot", i) for i in range(50)] + [("cold", 99), (None, 100), ("17", 101), ("absent", 102)]
    big = spark.createDataFrame(data, "k string, i int")
    lookup = big.filter("k in ('hot', 'cold')").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("i").alias("m"))
    out = joins.lookup_left(big, lookup, "k", spread_by=["i"], rows_per_key="n", hot_rows=hot_rows)
    got = {(r["k"], r["i"]): r["m"] for r in out.collect()}
    assert len(got) == len(data) == out.count()
    assert all(m == {"hot": 49, "cold": 99}.get(k) for (k, _), m in got.items())
