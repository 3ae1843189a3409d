"""Queries on single rows: validation, tagging, projection, scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.functions import net, text, timefns
from duskwatch.functions.registry import register_sql_functions
from duskwatch.operators import projections as P
from duskwatch.operators import validate as V
from duskwatch.plans.registry import query
from duskwatch.plans.views import IPV4_SQL, ip_long, is_home
from duskwatch.sources.sinks import retained
from duskwatch.sources.telemetry import Telemetry

NOW_US = 1706659200000000  # 2024-01-31T00:00:00Z

_TS_OK = "ends_with(timestamp, 'Z')"
_INT = r"regexp_matches({0}, '^\s*[+-]?\d+(\.0*)?\s*$')"


def _port(c: str) -> str:
    return f"{c} IS NOT NULL AND NOT coalesce(TRY_CAST({c} AS BIGINT) BETWEEN 0 AND 65535, false)"


_FIELD_CHECKS = {
    "eventid_format": r"NOT regexp_matches(eventid, '^cowrie\.[A-Za-z0-9_.-]+$') OR length(eventid) < 8",
    "timestamp_format": f"NOT {_TS_OK} OR TRY_CAST(timestamp AS TIMESTAMPTZ) IS NULL",
    "src_ip_format": f"NOT regexp_matches(src_ip, '{IPV4_SQL}')",
    "session_length": "length(session) NOT BETWEEN 1 AND 64",
    "sensor_empty": "length(sensor) < 1",
    "protocol_value": "protocol NOT IN ('ssh', 'telnet')",
    "src_port_range": _port("src_port"),
    "dst_port_range": _port("dst_port"),
    "duration_value": "duration IS NOT NULL AND NOT coalesce(TRY_CAST(duration AS DOUBLE) >= 0, false)",
}
# Written out, so that a wrong constant of the operators shows. The sample has no version and no hassh field.
_CROSS_CHECKS = {
    "cowrie.login.failed_needs_username_password": "eventid = 'cowrie.login.failed' AND (username IS NULL OR password IS NULL)",
    "cowrie.login.success_needs_username_password": "eventid = 'cowrie.login.success' AND (username IS NULL OR password IS NULL)",
    "cowrie.command.input_needs_input": "eventid = 'cowrie.command.input' AND input IS NULL",
    "cowrie.session.file_download_needs_url_shasum": "eventid = 'cowrie.session.file_download' AND (url IS NULL OR shasum IS NULL)",
    "cowrie.session.closed_needs_duration": "eventid = 'cowrie.session.closed' AND duration IS NULL",
    "cowrie.client.version_needs_version": "eventid = 'cowrie.client.version'",
    "cowrie.client.kex_needs_hassh": "eventid = 'cowrie.client.kex'",
    "cowrie.session.connect_needs_src_port_dst_port": "eventid = 'cowrie.session.connect' AND (src_port IS NULL OR dst_port IS NULL)",
}


def _failed(checks: dict[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for name, cond in checks.items())
    return f"concat_ws(',', {cases})"


def _field_sql(name: str) -> str:
    return f"SELECT event_id, {_failed(_FIELD_CHECKS)} AS failed FROM wire"


@query("validate_fields", _field_sql("fields"))
def validate_fields(t: Telemetry) -> DataFrame:
    wire = V.with_missing_fields(t.wire)
    return wire.select("event_id", F.concat_ws(",", V.broken(V.field_rules())).alias("failed"))


@query("validate_cross", f"SELECT event_id, {_failed(_CROSS_CHECKS)} AS failed FROM wire")
def validate_cross(t: Telemetry) -> DataFrame:
    wire = V.with_missing_fields(t.wire)
    return wire.select("event_id", F.concat_ws(",", V.broken(V.cross_rules())).alias("failed"))


@query(
    "quarantine_split",
    f"""SELECT eventid, hour, count(*) AS seen, count(*) FILTER (failed <> '') AS dropped,
  round(count(*) FILTER (failed <> '') / count(*), 6) AS drop_rate
FROM (SELECT eventid, substr(timestamp, 1, 13) AS hour, {_failed(_FIELD_CHECKS | _CROSS_CHECKS)} AS failed FROM wire)
GROUP BY ALL""",
)
def quarantine_split(t: Telemetry) -> DataFrame:
    return V.drop_rates(V.check_events(t.wire))


@query(
    "quarantine_reasons",
    f"""SELECT reason, count(*) AS events FROM (
  SELECT unnest(string_split({_failed(_FIELD_CHECKS | _CROSS_CHECKS)}, ',')) AS reason FROM wire)
WHERE reason <> '' GROUP BY ALL""",
)
def quarantine_reasons(t: Telemetry) -> DataFrame:
    _, bad = V.split_events(t.wire)
    return bad.select(F.explode("failed_rules").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("events"))


_VALID = f"({_failed(_FIELD_CHECKS | _CROSS_CHECKS)}) = ''"


@query(
    "conform_events",
    f"""SELECT eventid, session, src_ip, sensor, timestamp AS ts,
  epoch_us(CAST(timestamp AS TIMESTAMPTZ)) AS ts_us,
  'sha1:' || sha1(session || '|' || timestamp || '|' || eventid) AS ingest_id,
  coalesce(CAST(src_port AS BIGINT), -1) AS src_port, coalesce(CAST(dst_port AS BIGINT), -1) AS dst_port,
  protocol, username, input, url, shasum, CAST(duration AS DOUBLE) AS duration
FROM wire WHERE {_VALID}""",
)
def conform_events(t: Telemetry) -> DataFrame:
    good, _ = V.split_events(t.wire)
    typed = V.conform(V.strip_transport(good))
    ports = {c: F.coalesce(F.col(c).cast("bigint"), F.lit(-1).cast("bigint")) for c in ("src_port", "dst_port")}
    return typed.withColumns(ports).select(
        "eventid", "session", "src_ip", "sensor", "ts", "ts_us", "ingest_id", "src_port", "dst_port", "protocol",
        "username", "input", "url", "shasum", "duration",
    )


@query(
    "strip_transport",
    """SELECT event_id, eventid, timestamp, src_ip, session, sensor, protocol, src_port, dst_port, username, password,
  input, url, shasum, duration, country AS given_country, asn AS given_asn, asn_org AS given_asn_org
FROM wire LEFT JOIN geo ON geo.asn = event_id % 50""",
)
def strip_transport(t: Telemetry) -> DataFrame:
    given = t.geo_ranges.select("country", F.col("asn").cast("string").alias("asn"), "asn_org")
    keyed = t.wire.drop("k").withColumn("__asn", (F.col("event_id") % 50).cast("string"))
    return V.strip_transport(keyed.join(given, keyed["__asn"] == given["asn"], "left").drop("__asn"))


@query("event_id", "SELECT event_id, 'sha1:' || sha1(session || '|' || ts || '|' || eventid) AS ingest_id FROM hp")
def event_id(t: Telemetry) -> DataFrame:
    return t.events.select("event_id", V.event_key(F.col("session"), F.col("ts"), F.col("eventid")).alias("ingest_id"))


@query(
    "derive_keys",
    """SELECT event_id, substr(ts, 1, 10) AS day, substr(ts, 1, 13) AS hour, substr(ts, 1, 16) AS minute,
  'SESSION#' || session AS session_key, 'IP#' || src_ip AS ip_key, 'DAY#' || substr(ts, 1, 10) AS day_key,
  ts || '#' || eventid AS sort_key FROM hp""",
)
def derive_keys(t: Telemetry) -> DataFrame:
    return P.with_keys(t.events).select(
        "event_id", "day", "hour", "minute", "session_key", "ip_key", "day_key", "sort_key"
    )


PUBLIC_SQL = """eventid, session, src_ip, ts, sensor, src_port, CAST(NULL AS VARCHAR) AS dst_ip, dst_port, protocol,
  CAST(NULL AS VARCHAR) AS message, username, password, input, url, shasum, duration, country, asn, asn_org,
  CAST(NULL AS VARCHAR) AS correlation_status"""


@query("public_events", f"SELECT {PUBLIC_SQL} FROM stored")
def public_events(t: Telemetry) -> DataFrame:
    return P.public_events(t.stored)


@query(
    "sanitize_export",
    """SELECT event_id, eventid, session, ts, CASE WHEN src_ip = '45.3.3.7' THEN '203.0.113.1' ELSE src_ip END AS src_ip,
  CASE WHEN country IS NOT NULL THEN 'XX' END AS country, CASE WHEN asn IS NOT NULL THEN 0 END AS asn,
  CASE WHEN asn_org IS NOT NULL THEN 'TEST' END AS asn_org, password FROM stored""",
)
def sanitize_export(t: Telemetry) -> DataFrame:
    return P.sanitize(t.stored, "45.3.3.7").select(
        "event_id", "eventid", "session", "ts", "src_ip", "country", "asn", "asn_org", "password"
    )


_NEEDLES = ("password_raw", "token", "secret", "@")


@query(
    "leak_audit",
    """SELECT strftime(make_timestamp(1704067200000000 + (doc_id // 7) * 60000000), '%Y-%m-%dT%H:%M') AS minute,
  count(*) AS matches, true AS breach FROM documents
WHERE """
    + " OR ".join(f"contains(text, '{n}')" for n in _NEEDLES)
    + " GROUP BY ALL",
)
def leak_audit(t: Telemetry) -> DataFrame:
    """Documents stand for log lines, seven to a minute."""
    lines = t.table("documents").select(
        "text", (F.lit(1704067200000000) + F.floor(F.col("doc_id") / 7) * 60000000).alias("ts_us")
    )
    return P.leak_audit(lines, "text", "ts_us", _NEEDLES)


@query(
    "mitre_tag",
    """SELECT event_id, eventid, CASE eventid WHEN 'cowrie.login.failed' THEN 'T1110.001'
  WHEN 'cowrie.login.success' THEN 'T1078' WHEN 'cowrie.command.input' THEN 'T1059' END AS technique FROM hp""",
)
def mitre_tag(t: Telemetry) -> DataFrame:
    return t.events.select("event_id", "eventid", P.mitre_technique(F.col("eventid")).alias("technique"))


UNIFIED_SQL = """
SELECT source_event, log_source, ts_us, src_ip, dest_ip, severity, detail,
  CASE log_source WHEN 'honeypot' THEN 'honeypot' WHEN 'ids' THEN 'network_ids' ELSE 'network_metadata' END AS category,
  CASE WHEN log_source = 'ids' AND severity = 1 THEN 'high' END AS severity_label,
  CASE log_source WHEN 'honeypot' THEN 'cowrie,honeypot' WHEN 'ids' THEN 'suricata,ids'
    ELSE 'zeek,network_metadata' END AS tags
FROM (SELECT source_event, 'honeypot' AS log_source, ts_us, src_ip, CAST(NULL AS VARCHAR) AS dest_ip,
    CAST(NULL AS BIGINT) AS severity, eventid AS detail FROM honey
  UNION ALL SELECT source_event, 'ids', ts_us, src_ip, dest_ip, severity, signature FROM ids
  UNION ALL SELECT source_event, 'network', ts_us, src_ip, dest_ip, NULL, CAST(dest_port AS VARCHAR) FROM flows)"""


def unified(t: Telemetry) -> DataFrame:
    """Honeypot, IDS and network metadata in one stream with common columns."""
    honeypot = t.honeypot.select(
        "source_event", F.lit("honeypot").alias("log_source"), "ts_us", "src_ip", F.col("eventid").alias("detail")
    )
    ids = t.ids.select(
        "source_event", F.lit("ids").alias("log_source"), "ts_us", "src_ip", "dest_ip", "severity",
        F.col("signature").alias("detail"),
    )
    network = t.flows.select(
        "source_event", F.lit("network").alias("log_source"), "ts_us", "src_ip", "dest_ip",
        F.col("dest_port").cast("string").alias("detail"),
    )
    joined = honeypot.unionByName(ids, allowMissingColumns=True).unionByName(network, allowMissingColumns=True)
    return joined.withColumns(P.category_tags(F.col("log_source"), F.col("severity")))


@query("unified_logs", UNIFIED_SQL)
def unified_logs(t: Telemetry) -> DataFrame:
    return unified(t).withColumn("tags", F.concat_ws(",", "tags"))


@query(
    "category_tag",
    f"""SELECT category, severity_label, tags, count(*) AS records FROM ({UNIFIED_SQL}) GROUP BY ALL""",
)
def category_tag(t: Telemetry) -> DataFrame:
    return (
        unified_logs(t).groupBy("category", "severity_label", "tags").agg(F.count(F.lit(1)).alias("records"))
    )


@query(
    "normalize_ts",
    """SELECT event_id, coalesce(parsed, ts_us) AS event_us, raw IS NOT NULL AND parsed IS NULL AS time_parse_failed
FROM (SELECT *, epoch_us(TRY_CAST(raw AS TIMESTAMPTZ)) AS parsed FROM (
  SELECT event_id, ts_us, CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN 'not a time'
    WHEN 2 THEN substr(ts, 1, 19) || '+02:00' ELSE ts END AS raw FROM hp))""",
)
def normalize_ts(t: Telemetry) -> DataFrame:
    k = F.col("k") % 4
    raw = (
        F.when(k == 1, F.lit("not a time"))
        .when(k == 2, F.concat(F.left("ts", F.lit(19)), F.lit("+02:00")))
        .when(k == 3, F.col("ts"))
    )
    src = t.events.withColumn("raw", raw)
    times = P.normalized_time(F.col("raw"), F.timestamp_micros("ts_us"))
    return src.select(
        "event_id",
        F.unix_micros(times["event_time"]).alias("event_us"),
        times["time_parse_failed"].alias("time_parse_failed"),
    )


@query(
    "net_direction",
    f"""SELECT flow_id, {is_home('src_ip')} AS src_home, {is_home('dest_ip')} AS dest_home,
  CASE WHEN {is_home('src_ip')} AND NOT {is_home('dest_ip')} THEN 'outbound'
    WHEN NOT {is_home('src_ip')} AND {is_home('dest_ip')} THEN 'inbound'
    WHEN {is_home('src_ip')} THEN 'internal' ELSE 'external' END AS flow_direction FROM flows""",
)
def net_direction(t: Telemetry) -> DataFrame:
    src, dst = F.col("src_ip"), F.col("dest_ip")
    return t.flows.select(
        "flow_id",
        net.is_home(src).alias("src_home"),
        net.is_home(dst).alias("dest_home"),
        net.direction(src, dst).alias("flow_direction"),
    )


@query(
    "retention_filter",
    f"""SELECT event_id, ts_us, ts_us + 5184000000000 AS expires_us, kind FROM (
  SELECT event_id, ts_us, 'hourly' AS kind FROM hp WHERE ts_us > {NOW_US + 45 * 86400 * 10**6} - 5184000000000)
UNION ALL SELECT event_id, ts_us, ts_us + 7776000000000, 'event' FROM hp
WHERE ts_us > {NOW_US + 75 * 86400 * 10**6} - 7776000000000
UNION ALL SELECT event_id, ts_us, ts_us + 93600000000, 'rank' FROM hp WHERE ts_us > {NOW_US} - 93600000000""",
)
def retention_filter(t: Telemetry) -> DataFrame:
    """What each kind keeps at a clock of its own."""
    rows = t.events.select("event_id", "ts_us")
    day = 86400 * 10**6
    kept = [
        retained(rows, kind, "ts_us", now).withColumn("kind", F.lit(kind))
        for kind, now in (("hourly", NOW_US + 45 * day), ("event", NOW_US + 75 * day), ("rank", NOW_US))
    ]
    return kept[0].unionByName(kept[1]).unionByName(kept[2])


@query(
    "fn_ip",
    f"""SELECT event_id, {ip_long('src_ip')} AS ip_long, regexp_matches(wire_ip, '{IPV4_SQL}') AS valid,
  ({ip_long('src_ip')}) // 65536 * 65536 AS net_lo, ({ip_long('src_ip')}) // 65536 * 65536 + 65535 AS net_hi
FROM (SELECT event_id, src_ip, CASE WHEN k = 92 THEN '300.1.2.3' ELSE src_ip END AS wire_ip FROM hp)""",
)
def fn_ip(t: Telemetry) -> DataFrame:
    cidr = F.concat("src_ip", F.lit("/16"))
    wire_ip = F.when(F.col("k") == 92, F.lit("300.1.2.3")).otherwise(F.col("src_ip"))
    return t.events.select(
        "event_id",
        net.ip_to_long(F.col("src_ip")).alias("ip_long"),
        net.is_ip(wire_ip).alias("valid"),
        net.cidr_lo(cidr).alias("net_lo"),
        net.cidr_hi(cidr).alias("net_hi"),
    )


@query(
    "fn_ts_us",
    """SELECT event_id, ts_us AS us_z, ts_us AS us_offset, ts AS back FROM hp""",
)
def fn_ts_us(t: Telemetry) -> DataFrame:
    us = timefns.iso_to_us(F.col("ts"))
    offset = F.concat(F.left("ts", F.lit(26)), F.lit("+00:00"))
    return t.events.select(
        "event_id", us.alias("us_z"), timefns.iso_to_us(offset).alias("us_offset"), timefns.us_to_iso(us).alias("back")
    )


@query(
    "fn_redaction",
    """SELECT doc_id, '<filtered:len=' || length(text) || '>' AS marker, CAST(length(text) AS BIGINT) AS parsed,
  CAST(NULL AS BIGINT) AS not_a_marker FROM documents""",
)
def fn_redaction(t: Telemetry) -> DataFrame:
    marker = text.redaction_marker(F.col("text"))
    return t.table("documents").select(
        "doc_id",
        marker.alias("marker"),
        text.redaction_length(marker).cast("bigint").alias("parsed"),
        text.redaction_length(F.concat(F.lit("x"), marker)).cast("bigint").alias("not_a_marker"),
    )


@query(
    "fn_buckets",
    """SELECT event_id, strftime(make_timestamp(ts_us - 20000000), '%Y-%m-%dT%H:%M') || CASE
    WHEN (ts_us - 20000000) // 60000000 = ts_us // 60000000 THEN '' ELSE ',' || substr(ts, 1, 16) END AS buckets
FROM hp""",
)
def fn_buckets(t: Telemetry) -> DataFrame:
    buckets = timefns.minute_bucket_list(F.col("ts_us"), 20_000_000)
    return t.events.select("event_id", F.concat_ws(",", buckets).alias("buckets"))


@query(
    "sql_functions",
    f"""SELECT event_id, {ip_long('src_ip')} AS ip_long, ts_us AS us,
  '<filtered:len=' || coalesce(length(password), 0) || '>' AS marker, coalesce(length(password), 0) AS marker_len,
  true AS valid_ip,
  CASE WHEN coalesce(duration, 9.0) < 2.0 AND k % 3 + k % 5 = 0 THEN 'scanner'
    WHEN 12 - k % 7 >= 10 AND k % 3 + k % 5 > 0 THEN 'credential_stuffing' ELSE 'other' END AS label
FROM hp""",
)
def sql_functions(t: Telemetry) -> DataFrame:
    """The registered SQL functions used from SQL text."""
    register_sql_functions(t.spark)
    t.events.createOrReplaceTempView("hp_for_sql_functions")
    return t.spark.sql(
        """SELECT event_id, ip_as_long(src_ip) AS ip_long, iso_micros(ts) AS us,
  redaction_mark(coalesce(password, '')) AS marker,
  CAST(redaction_len(redaction_mark(coalesce(password, ''))) AS BIGINT) AS marker_len,
  is_ip_address(src_ip) AS valid_ip,
  technique_label(coalesce(duration, 9.0D), k % 3, k % 5, 12 - k % 7) AS label
FROM hp_for_sql_functions"""
    )
