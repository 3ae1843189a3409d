"""Validation of wire events: field rules, rules per event type, split with reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.functions.net import is_ip
from duskwatch.functions.timefns import iso_timestamp
from duskwatch.schemas import EVENT_FIELDS, GIVEN_FIELDS, LIST_FIELDS, REQUIRED_FIELDS, TRANSPORT_FIELDS

EVENTID_PATTERN = r"^cowrie\.[A-Za-z0-9_.-]+$"
_INT_TEXT = r"^\s*[+-]?\d+(\.0*)?\s*$"
_FLOAT_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Fields each event type must carry.
REQUIRED_BY_TYPE = {
    "cowrie.login.failed": ("username", "password"),
    "cowrie.login.success": ("username", "password"),
    "cowrie.command.input": ("input",),
    "cowrie.session.file_download": ("url", "shasum"),
    "cowrie.session.closed": ("duration",),
    "cowrie.client.version": ("version",),
    "cowrie.client.kex": ("hassh",),
    "cowrie.session.connect": ("src_port", "dst_port"),
}


def int_value(text: Column) -> Column:
    """Whole-number text as BIGINT, null for anything else."""
    return F.when(text.rlike(_INT_TEXT), F.regexp_replace(F.trim(text), r"\.0*$", "").try_cast("bigint"))


def float_value(text: Column) -> Column:
    return F.when(text.rlike(_FLOAT_TEXT), F.trim(text).try_cast("double"))


def field_rules() -> dict[str, Column]:
    """Rule name to a condition that is true when the event breaks it."""
    c = F.col
    rules = {f"missing_{name}": c(name).isNull() for name in REQUIRED_FIELDS}
    rules |= {
        "eventid_format": ~c("eventid").rlike(EVENTID_PATTERN) | (F.length("eventid") < 8),
        "timestamp_format": ~c("timestamp").endswith("Z") | iso_timestamp(c("timestamp")).isNull(),
        "src_ip_format": ~is_ip(c("src_ip")),
        "dst_ip_format": ~is_ip(c("dst_ip")),
        "session_length": ~F.length("session").between(1, 64),
        "sensor_empty": F.length("sensor") < 1,
        "protocol_value": ~c("protocol").isin("ssh", "telnet"),
        "src_port_range": c("src_port").isNotNull()
        & ~F.coalesce(int_value(c("src_port")).between(0, 65535), F.lit(False)),
        "dst_port_range": c("dst_port").isNotNull()
        & ~F.coalesce(int_value(c("dst_port")).between(0, 65535), F.lit(False)),
        "duration_value": c("duration").isNotNull()
        & ~F.coalesce(float_value(c("duration")) >= 0, F.lit(False)),
    }
    rules |= {
        f"{name}_list": c(name).isNotNull() & ~F.coalesce(F.trim(c(name)).startswith("["), F.lit(False))
        for name in LIST_FIELDS
    }
    return rules


def cross_rules() -> dict[str, Column]:
    out = {}
    for eventid, fields in REQUIRED_BY_TYPE.items():
        lacking = F.lit(False)
        for f in fields:
            lacking = lacking | F.col(f).isNull()
        out[f"{eventid}_needs_{'_'.join(fields)}"] = (F.col("eventid") == eventid) & lacking
    return out


def broken(rules: dict[str, Column]) -> Column:
    """Names of the broken rules as an array."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))


def with_missing_fields(df: DataFrame) -> DataFrame:
    """Add wire fields the source does not have as nulls."""
    absent = {f: F.lit(None).cast("string") for f in EVENT_FIELDS if f not in df.columns}
    return df.withColumns(absent) if absent else df


def check_events(df: DataFrame) -> DataFrame:
    """Add ``failed_rules``; field rules come before rules per event type."""
    return compute_once(with_missing_fields(df), failed_rules=broken(field_rules() | cross_rules()))


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns behind a generator, so that later filters on them do not repeat the expression."""
    one_row = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    return df.select("*", F.inline(one_row))


def split_events(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    checked = check_events(df)
    if "malformed" in df.columns:
        checked = checked.withColumn(
            "failed_rules", F.when(F.col("malformed"), F.array(F.lit("not_json"))).otherwise(F.col("failed_rules"))
        )
    good = F.size("failed_rules") == 0
    return checked.filter(good), checked.filter(~good)


def drop_rates(checked: DataFrame) -> DataFrame:
    """Seen, dropped and drop rate per event type and hour of the wire timestamp."""
    return (
        checked.groupBy("eventid", F.substring("timestamp", 1, 13).alias("hour"))
        .agg(F.count(F.lit(1)).alias("seen"), F.count_if(F.size("failed_rules") > 0).alias("dropped"))
        .withColumn("drop_rate", F.round(F.col("dropped") / F.col("seen"), 6))
    )


def strip_transport(df: DataFrame) -> DataFrame:
    """Drop shipper metadata and set given enrichment aside as ``given_*``."""
    out = df.drop(*TRANSPORT_FIELDS)
    for name in GIVEN_FIELDS:
        if name in out.columns:
            kind = "bigint" if name == "asn" else "string"
            out = out.withColumn(f"given_{name}", F.col(name).try_cast(kind)).drop(name)
    return out


def conform(df: DataFrame) -> DataFrame:
    """Valid wire events as typed columns; unknown fields and cipher lists are not kept."""
    c = F.col
    src = with_missing_fields(df)
    given = [name for name in ("given_country", "given_asn", "given_asn_org") if name in src.columns]
    return src.select(
        "eventid",
        "session",
        "src_ip",
        "sensor",
        c("timestamp").alias("ts"),
        F.unix_micros(iso_timestamp(c("timestamp"))).alias("ts_us"),
        event_key(c("session"), c("timestamp"), c("eventid")).alias("ingest_id"),
        int_value(c("src_port")).cast("int").alias("src_port"),
        "dst_ip",
        int_value(c("dst_port")).cast("int").alias("dst_port"),
        "protocol",
        c("uuid").alias("sensor_uuid"),
        "message",
        "username",
        "password",
        "version",
        "hassh",
        "input",
        "url",
        "outfile",
        "shasum",
        float_value(c("duration")).alias("duration"),
        *given,
    )


def event_key(session: Column, ts: Column, eventid: Column) -> Column:
    """Deterministic id of an event."""
    return F.concat(F.lit("sha1:"), F.sha1(F.concat_ws("|", session, ts, eventid)))
