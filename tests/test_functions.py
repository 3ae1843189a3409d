import ipaddress
from datetime import datetime, timedelta, timezone

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from duskwatch.functions import net, text, timefns
from duskwatch.functions.registry import register_sql_functions


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def valid(ip):
    try:
        ipaddress.ip_address(ip)
        return True
    except ValueError:
        return False


ADDRESSES = [
    "0.0.0.0", "255.255.255.255", "256.1.1.1", "1.2.3", "01.2.3.4", "1.2.3.4 ", "", "a.b.c.d", "::", "::1", "1::",
    "2001:db8::1", "2001:db8:0:0:0:0:0:1", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "::ffff:1.2.3.4",
    "64:ff9b::192.0.2.33", "fe80::1%eth0", ":::", "1::2::3", "12345::", "::g", "1:2:3:4:5:6:1.2.3.4", "1::1.2.3.4",
]


def test_address_validity_agrees_with_the_standard_library(spark):
    assert column(spark, ADDRESSES, net.is_ip) == [valid(a) for a in ADDRESSES]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=30))
def test_ip_to_long_round_trip(spark, numbers):
    texts = [str(ipaddress.IPv4Address(n)) for n in numbers]
    assert column(spark, texts, net.ip_to_long) == numbers


def test_cidr_bounds(spark):
    cidrs = ["10.1.2.3/12", "192.0.2.0/24", "192.0.2.7/32", "0.0.0.0/0", "x/8"]
    nets = [ipaddress.ip_network(c, strict=False) for c in cidrs[:-1]]
    assert column(spark, cidrs, net.cidr_lo) == [int(n[0]) for n in nets] + [None]
    assert column(spark, cidrs, net.cidr_hi) == [int(n[-1]) for n in nets] + [None]


def test_home_networks_and_direction(spark):
    ips = ["10.0.0.1", "172.15.0.1", "172.16.0.1", "172.31.255.255", "172.32.0.1", "192.168.9.9", "192.169.0.1", "x", None]
    assert column(spark, ips, net.is_home) == [True, False, True, True, False, True, False, False, False]
    df = spark.createDataFrame([("10.0.0.1", "8.8.8.8"), ("8.8.8.8", "10.0.0.1"), ("10.0.0.1", "10.0.0.2")], "a string, b string")
    got = [r[0] for r in df.select(net.direction(F.col("a"), F.col("b"))).collect()]
    assert got == ["outbound", "inbound", "internal"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.datetimes(datetime(1971, 1, 1), datetime(2200, 1, 1)), min_size=1, max_size=20), st.integers(-14 * 4, 14 * 4))
def test_timestamps_agree_with_the_standard_library(spark, times, quarters):
    zone = timezone(timedelta(minutes=15 * quarters))
    us = [(t - datetime(1970, 1, 1)) // timedelta(microseconds=1) for t in times]
    plain = [t.isoformat(timespec="microseconds") for t in times]
    zoned = [t.replace(tzinfo=timezone.utc).astimezone(zone).isoformat(timespec="microseconds") for t in times]
    assert column(spark, plain, timefns.iso_to_us) == us
    assert column(spark, [p + "Z" for p in plain], timefns.iso_to_us) == us
    assert column(spark, zoned, timefns.iso_to_us) == us
    assert column(spark, us, lambda c: timefns.us_to_iso(c, "+00:00"), "bigint") == [p + "+00:00" for p in plain]


def test_texts_that_are_dates_or_no_timestamps(spark):
    leap = (datetime(2032, 2, 29) - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    assert column(spark, ["2032-02-29", "2031-02-29T08:00:00Z", "noon", None], timefns.iso_to_us) == [leap, None, None, None]


def test_minute_buckets(spark):
    us = (datetime(2031, 12, 31, 23, 59) - datetime(1970, 1, 1)) // timedelta(microseconds=1) + 30_000  # 30 ms into the year's last minute
    got = column(spark, [us, us + 400_000], lambda c: timefns.minute_bucket_list(c, 150_000), "bigint")
    assert got == [["2031-12-31T23:58", "2031-12-31T23:59"], ["2031-12-31T23:59"]]


def test_redaction(spark):
    words = ["secret", "", "pässwörd😀", None]
    marks = column(spark, words, text.redaction_marker)
    assert marks == ["<filtered:len=6>", "<filtered:len=0>", "<filtered:len=9>", None]
    assert column(spark, [*marks, "<filtered:len=x>", "plain"], text.redaction_length) == [6, 0, 9, None, None, None]


def test_first_token_splits_like_python(spark):
    lines = ["uname -a", "  cat\t/etc", "", "   ", " wget x", "a\x1cb", "\xa0ls", None]
    want = [None if v is None or not v.split() else v.split()[0] for v in lines]
    assert column(spark, lines, text.first_token) == want


def test_template(spark):
    got = column(spark, ["1.2.3.4", None], lambda c: text.fill_template("from $(ip)!", {"ip": c}))
    assert got == ["from 1.2.3.4!", "from !"]


def test_sql_functions(spark):
    register_sql_functions(spark)
    row = spark.sql(
        "SELECT ip_as_long('1.2.3.4'), is_ip_address('1.2.3'), redaction_len(redaction_mark('abc')), "
        "technique_label(1.5D, 0L, 0L, 0L), technique_label(10D, 5L, 0L, 1L), technique_label(10D, 8L, 2L, 10L)"
    ).first()
    assert tuple(row) == (16909060, False, 3, "scanner", "brute_force", "credential_stuffing")
