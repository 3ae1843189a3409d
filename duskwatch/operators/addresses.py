"""Range lookups of IPv4 and IPv6 addresses: an equi join on the prefixes that ranges are made of.

Each range is a handful of aligned prefixes (at most 254), and an address is looked up under one key for each prefix
length that the range table has. Distinct addresses are looked up once, whatever the number of their rows. IPv4 counts as
IPv4-mapped IPv6, so ``::ffff:192.0.2.1`` finds the ranges of ``192.0.2.1``.
"""

from __future__ import annotations

import ipaddress
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.operators.joins import HOT_ROWS, lookup_left
from duskwatch.session import stage

MAPPED = 0xFFFF << 32


def number(text: str | None) -> int | None:
    """An address as a 128-bit number, null when it is not one. A zone after % is left out."""
    try:
        address = ipaddress.ip_address(text)
    except ValueError:
        return None
    return int(address) | MAPPED if address.version == 4 else int(address)


def bounds(first: str | None, last: str | None) -> tuple[int, int] | None:
    """A range given by two addresses, or by a network where there is no last one."""
    try:
        if last is None:
            network = ipaddress.ip_network(first, strict=False)
            return number(str(network[0])), number(str(network[-1]))
    except ValueError:
        return None
    lo, hi = number(first), number(last)
    return None if lo is None or hi is None or lo > hi else (lo, hi)


def key_of(value: int, length: int) -> str:
    """The first ``length`` bits of an address, with their number."""
    return f"{length}:{value >> (128 - length):x}"


def prefix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each range's prefixes, with its number of addresses and first address as text that sorts like the numbers."""
    for batch in batches:
        row, keys, lengths, spans, starts = [], [], [], [], []
        for i, (first, last) in enumerate(zip(batch.column("first").to_pylist(), batch.column("last").to_pylist())):
            found = bounds(first, last)
            if found is None:
                continue
            for net in ipaddress.summarize_address_range(*map(ipaddress.IPv6Address, found)):
                row.append(i)
                keys.append(key_of(int(net[0]), net.prefixlen))
                lengths.append(net.prefixlen)
                spans.append(f"{found[1] - found[0]:032x}")
                starts.append(f"{found[0]:032x}")
        made = [pa.array(keys, pa.string()), pa.array(lengths, pa.int32()), pa.array(spans, pa.string()), pa.array(starts, pa.string())]
        yield pa.RecordBatch.from_arrays([*made, batch.column("values").take(pa.array(row, pa.int64()))], ["key", "length", "span", "start", "values"])


def address_keys(lengths: list[int]):
    """Each address under the prefix lengths of the range table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ips, keys = [], []
            for ip in batch.column("ip").to_pylist():
                value = number(ip)
                if value is not None:
                    ips += [ip] * len(lengths)
                    keys += [key_of(value, n) for n in lengths]
            yield pa.RecordBatch.from_arrays([pa.array(ips, pa.string()), pa.array(keys, pa.string())], ["ip", "key"])

    return run


def address_range_join(df: DataFrame, ip: str, ranges: DataFrame, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join each address to its narrowest range, of equal ones the first; unknown or invalid addresses get nulls.

    Ranges have ``first`` and ``last``, addresses of one family or a network and null, and the columns to be added.
    """
    values = [c for c in ranges.columns if c not in ("first", "last")]
    given = ranges.select("first", "last", F.struct(*values).alias("values"))
    kind = given.schema["values"].dataType.simpleString()
    prefixes = given.mapInArrow(prefix_rows, f"key string, length int, span string, start string, values {kind}")
    best = stage(prefixes.groupBy("key", "length").agg(F.min(F.struct("span", "start", "values")).alias("best")), "prefixes")
    lengths = sorted(r[0] for r in best.select("length").distinct().collect())  # 129 at most
    addresses = df.filter(F.col(ip).isNotNull()).groupBy(F.col(ip).alias("ip")).agg(F.count(F.lit(1)).alias("__rows"))
    addresses = stage(addresses, "addresses")
    found = addresses.select("ip").mapInArrow(address_keys(lengths), "ip string, key string").join(best, "key").groupBy("ip").agg(F.min("best").alias("best"))
    lookup = found.join(addresses, "ip").select(F.col("ip").alias(ip), *[F.col(f"best.values.{c}").alias(c) for c in values], "__rows")
    return lookup_left(df, lookup, ip, spread_by=df.columns[:4], rows_per_key="__rows", hot_rows=hot_rows)
