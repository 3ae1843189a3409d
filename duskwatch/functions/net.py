"""IP address expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4_PATTERN = rf"^({_OCTET}\.){{3}}{_OCTET}$"
_H = "[0-9A-Fa-f]{1,4}"
_V4_TAIL = rf"({_OCTET}\.){{3}}{_OCTET}"
IPV6_PATTERN = (
    "^("
    rf"({_H}:){{7}}{_H}"
    rf"|({_H}:){{1,7}}:"
    rf"|({_H}:){{1,6}}:{_H}"
    rf"|({_H}:){{1,5}}(:{_H}){{1,2}}"
    rf"|({_H}:){{1,4}}(:{_H}){{1,3}}"
    rf"|({_H}:){{1,3}}(:{_H}){{1,4}}"
    rf"|({_H}:){{1,2}}(:{_H}){{1,5}}"
    rf"|{_H}:(:{_H}){{1,6}}"
    rf"|:((:{_H}){{1,7}}|:)"
    rf"|({_H}:){{6}}{_V4_TAIL}"
    rf"|::({_H}:){{0,5}}{_V4_TAIL}"
    rf"|({_H}:){{1,5}}:{_V4_TAIL}"
    ")(%[^%/]+)?$"
)
# RFC 1918 networks treated as "home".
HOME_NETWORKS = ("10.0.0.0/8", "172.16.0.0/12", "192.168.0.0/16")
LOOPBACK = "127.0.0.1"


def is_ipv4(ip: Column) -> Column:
    return ip.rlike(IPV4_PATTERN)


def is_ip(ip: Column) -> Column:
    """True for a valid IPv4 or IPv6 address; null stays null."""
    return ip.rlike(IPV4_PATTERN) | ip.rlike(IPV6_PATTERN)


def ip_to_long(ip: Column) -> Column:
    """IPv4 text as BIGINT, null when it is not a valid IPv4 address."""
    part = F.split(ip, r"\.")
    value = F.lit(0).cast("bigint")
    for i in range(4):
        value = value * 256 + F.get(part, F.lit(i)).cast("bigint")
    return F.when(is_ipv4(ip), value)


def cidr_lo(cidr: Column) -> Column:
    base = ip_to_long(F.substring_index(cidr, "/", 1))
    host_bits = _host_bits(cidr)
    return F.call_function("shiftleft", F.call_function("shiftright", base, host_bits), host_bits)


def cidr_hi(cidr: Column) -> Column:
    return cidr_lo(cidr) + F.call_function("shiftleft", F.lit(1).cast("bigint"), _host_bits(cidr)) - 1


def _host_bits(cidr: Column) -> Column:
    return F.lit(32) - F.substring_index(cidr, "/", -1).try_cast("int")


def _network_pattern(cidr: str) -> str:
    """Pattern of the addresses in a network: whole octets as text, a cut octet as its list of values."""
    base, _, bits = cidr.partition("/")
    octets, whole = base.split("."), int(bits) // 8
    parts = [re.escape(o) for o in octets[:whole]]
    if int(bits) % 8:
        free = 8 - int(bits) % 8
        first = int(octets[whole]) >> free << free
        parts.append("(" + "|".join(str(first + i) for i in range(1 << free)) + ")")
    parts += [_OCTET] * (4 - len(parts))
    return r"\.".join(parts)


def is_home(ip: Column, networks: tuple[str, ...] = HOME_NETWORKS) -> Column:
    """Membership of the home networks; not-an-address counts as not home."""
    pattern = "^(" + "|".join(_network_pattern(n) for n in networks) + ")$"
    return F.coalesce(ip.rlike(pattern), F.lit(False))


def direction(src: Column, dst: Column) -> Column:
    """outbound (home to external), inbound, internal or external."""
    return (
        F.when(is_home(src) & ~is_home(dst), "outbound")
        .when(~is_home(src) & is_home(dst), "inbound")
        .when(is_home(src) & is_home(dst), "internal")
        .otherwise("external")
    )
