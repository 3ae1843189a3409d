"""Timestamp text, epoch microseconds and bucket keys (all UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_US = 60_000_000
HOUR_US = 3_600_000_000
DAY_US = 86_400_000_000

_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
_ISO_ZONED = r"(Z|[+-]\d{2}:?\d{2})$"


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text as TIMESTAMP, null when it does not parse; no zone means UTC."""
    zoned = F.when(text.rlike("T.*" + _ISO_ZONED) | text.rlike(" .*" + _ISO_ZONED), text).otherwise(
        F.concat(F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00"))).otherwise(text), F.lit("Z"))
    )
    return F.when(text.rlike(_ISO), F.try_to_timestamp(zoned))


def iso_to_us(text: Column) -> Column:
    return F.unix_micros(iso_timestamp(text))


def us_to_iso(us: Column, zone_text: str = "Z") -> Column:
    """Epoch microseconds as ISO text with six fraction digits."""
    return F.concat(F.date_format(F.timestamp_micros(us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(zone_text))


def day_key(ts: Column) -> Column:
    return F.substring(ts, 1, 10)


def hour_key(ts: Column) -> Column:
    return F.substring(ts, 1, 13)


def minute_key(ts: Column) -> Column:
    return F.substring(ts, 1, 16)


def minute_bucket_list(us: Column, window_us: int) -> Column:
    """Minute keys touched by ``[us - window, us]``."""
    first = F.floor((us - F.lit(window_us)) / F.lit(MINUTE_US)).cast("bigint")
    last = F.floor(us / F.lit(MINUTE_US)).cast("bigint")
    return F.transform(
        F.sequence(first, last),
        lambda m: F.date_format(F.timestamp_seconds(m * 60), "yyyy-MM-dd'T'HH:mm"),
    )


def floor_div(us: Column, width: int) -> Column:
    """Integer bucket number; ``pmod`` keeps it exact for BIGINT and right below zero."""
    w = F.lit(width).cast("bigint")
    return F.call_function("div", us - F.pmod(us, w), w)
