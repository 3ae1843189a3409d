"""Range lookups of both address families against the standard library."""

import ipaddress
import random

from pyspark.sql import functions as F

from duskwatch.operators.addresses import address_range_join


def by_hand(ip, ranges):
    def number(text):
        try:
            a = ipaddress.ip_address(text)
        except ValueError:
            return None
        return int(a) if a.version == 6 else (0xFFFF << 32) + int(a)

    n, hits = number(ip), []
    for first, last, name in ranges:
        try:
            net = ipaddress.ip_network(first, strict=False) if last is None else None
        except ValueError:
            continue
        lo, hi = (number(str(net[0])), number(str(net[-1]))) if net else (number(first), number(last))
        if n is not None and lo is not None and hi is not None and lo <= n <= hi:
            hits.append((hi - lo, lo, name))
    return min(hits)[2] if hits else None


def test_ranges_of_both_families(spark):
    rng = random.Random(12)
    ranges = [("::/0", None, "all"), ("0.0.0.0/0", None, "v4"), ("not an address", None, "x"), ("192.0.2.9", "192.0.2.1", "turned"), ("2001:db8::/33", None, "b"), ("2001:db8::/33", None, "a"), ("10.0.0.5/8", None, "ten")]
    ips = [None, "", "x", "1.2.3", "::", "ffff:" * 7 + "ffff", "255.255.255.255", "fe80::1%eth0", "::ffff:10.9.9.9", "10.9.9.9", "2001:DB8::1"]
    for i in range(60):
        if rng.random() < 0.5:
            at, span = (0x20010DB8 << 96) + rng.randrange(1 << 20), rng.choice([0, 1, 6, 1000, 1 << 19])
            first, last = ipaddress.IPv6Address(at), ipaddress.IPv6Address(at + span)
        else:
            at, span = (203 << 24) + rng.randrange(1 << 12), rng.choice([0, 1, 5, 300])
            first, last = ipaddress.IPv4Address(at), ipaddress.IPv4Address(at + span)
        ranges.append((str(first), str(last), f"r{i}"))
        for border in (int(first) - 1, int(first), int(last), int(last) + 1):
            a = type(first)(border)
            ips += [str(a), a.exploded.upper()] + ([f"::ffff:{a}"] if a.version == 4 else [])
    table = spark.createDataFrame(ranges, "first string, last string, name string")
    df = spark.createDataFrame(list(enumerate(ips)), "i int, ip string")
    for hot in (1, 5_000_000):
        got = {r["i"]: r["name"] for r in address_range_join(df, "ip", table, hot_rows=hot).collect()}
        assert got == {i: by_hand(ip, ranges) for i, ip in enumerate(ips)}


def test_empty_sides(spark):
    table = spark.createDataFrame([("10.0.0.0/8", None, "ten")], "first string, last string, name string")
    df = spark.createDataFrame([("10.1.1.1",), (None,)], "ip string")
    assert address_range_join(df, "ip", table.limit(0)).filter(F.col("name").isNotNull()).count() == 0
    assert address_range_join(df.limit(0), "ip", table).count() == 0
    assert sorted(map(str, (r["name"] for r in address_range_join(df, "ip", table).collect()))) == ["None", "ten"]
