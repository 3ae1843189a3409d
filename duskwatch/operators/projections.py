"""Row-wise tagging, public projections and audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.functions.timefns import day_key, hour_key, iso_timestamp, minute_key
from duskwatch.schemas import PUBLIC_COLUMNS, TRANSPORT_FIELDS

# Technique of an event type (fixed values).
MITRE_BY_EVENT = {
    "cowrie.login.failed": "T1110.001",
    "cowrie.login.success": "T1078",
    "cowrie.command.input": "T1059",
}


def with_keys(events: DataFrame) -> DataFrame:
    """Bucket and access keys as plain columns."""
    return events.withColumns(
        {
            "day": day_key(F.col("ts")),
            "hour": hour_key(F.col("ts")),
            "minute": minute_key(F.col("ts")),
            "session_key": F.concat(F.lit("SESSION#"), F.col("session")),
            "ip_key": F.concat(F.lit("IP#"), F.col("src_ip")),
            "day_key": F.concat(F.lit("DAY#"), day_key(F.col("ts"))),
            "sort_key": F.concat_ws("#", "ts", "eventid"),
        }
    )


def public_events(events: DataFrame) -> DataFrame:
    """Only the allow-listed columns; one the frame lacks becomes null."""
    return events.select(
        *[F.col(c) if c in events.columns else F.lit(None).cast("string").alias(c) for c in PUBLIC_COLUMNS]
    )


def sanitize(events: DataFrame, private_ip: str, replacement: str = "203.0.113.1") -> DataFrame:
    """Publishable copy: no private or transport columns, one address replaced, geo blanked."""
    out = events.drop("password_raw", *TRANSPORT_FIELDS).withColumn(
        "src_ip", F.when(F.col("src_ip") == private_ip, replacement).otherwise(F.col("src_ip"))
    )
    blanks = {"country": F.lit("XX"), "asn": F.lit(0).cast("bigint"), "asn_org": F.lit("TEST")}
    for name, blank in blanks.items():
        if name in out.columns:
            out = out.withColumn(name, F.when(F.col(name).isNotNull(), blank))
    return out


def leak_audit(records: DataFrame, text: str, ts_us: str, needles: Sequence[str]) -> DataFrame:
    """Records per minute whose text holds a private name or value; any count is a breach."""
    found = F.lit(False)
    for needle in needles:
        found = found | F.contains(F.col(text), F.lit(needle))
    return (
        records.filter(found)
        .groupBy(F.window(F.timestamp_micros(ts_us), "1 minute").alias("w"))
        .agg(F.count(F.lit(1)).alias("matches"))
        .select(F.date_format("w.start", "yyyy-MM-dd'T'HH:mm").alias("minute"), "matches", F.lit(True).alias("breach"))
    )


def mitre_technique(eventid: Column) -> Column:
    out: Column | None = None
    for name, technique in MITRE_BY_EVENT.items():
        out = F.when(eventid == name, technique) if out is None else out.when(eventid == name, technique)
    return out


def category_tags(log_source: Column, severity: Column) -> dict[str, Column]:
    """Category, severity label and tags by log source."""
    honeypot, ids, net = log_source == "honeypot", log_source == "ids", log_source == "network"
    return {
        "category": F.when(honeypot, "honeypot").when(ids, "network_ids").when(net, "network_metadata"),
        "severity_label": F.when(ids & (severity == 1), "high"),
        "tags": F.when(honeypot, F.array(F.lit("cowrie"), F.lit("honeypot")))
        .when(ids, F.array(F.lit("suricata"), F.lit("ids")))
        .when(net, F.array(F.lit("zeek"), F.lit("network_metadata"))),
    }


def normalized_time(ts_text: Column, arrival: Column) -> dict[str, Column]:
    """Event time from ISO text, else the arrival time; text that does not parse is flagged."""
    parsed = iso_timestamp(ts_text)
    return {
        "event_time": F.coalesce(parsed, arrival),
        "time_parse_failed": ts_text.isNotNull() & parsed.isNull(),
    }
