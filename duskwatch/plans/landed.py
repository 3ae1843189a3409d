"""Queries on landed files: telemetry is written to the shared work folder and scanned back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.operators import reports
from duskwatch.operators.enrich import geo_enrich
from duskwatch.plans import counts  # noqa: F401  the twins of the reports are registered there
from duskwatch.plans.registry import SQL, query
from duskwatch.plans.rows import _VALID, UNIFIED_SQL, unified
from duskwatch.session import work_dir
from duskwatch.sources import dims, logs, sinks
from duskwatch.sources.store import AppendTable, event_store
from duskwatch.sources.telemetry import Telemetry

WIRE = (
    "eventid", "timestamp", "src_ip", "session", "sensor", "protocol", "src_port", "dst_port", "username", "password",
    "input", "url", "shasum", "duration",
)


def event_line() -> Column:
    """A wire row as JSON; some lines are cut short."""
    whole = F.to_json(F.struct(*WIRE, "fluent_host", "fluent_source"))
    return F.when(F.col("k") == 13, F.left(whole, F.lit(20))).otherwise(whole)


def proxy_line() -> Column:
    """A proxy row as JSON, with a missing or wrong field now and then."""
    k, c = F.col("duration"), F.col
    return F.to_json(
        F.struct(
            F.when(k == 6, F.lit("yesterday"))
            .when(k % 2 == 0, F.replace("ts", F.lit("+00:00"), F.lit("Z")))
            .otherwise(c("ts"))
            .alias("time"),
            F.when(k != 5, c("client_ip")).alias("client_ip"),
            c("client_port"),
            c("frontend_port"),
            F.when(k != 7, c("duration").cast("string")).alias("duration"),
            F.concat(F.lit("+"), c("bytes_uploaded").cast("string")).alias("bytes_uploaded"),
            c("bytes_downloaded"),
            c("status"),
        )
    )


def land(t: Telemetry, df: DataFrame, line: Column, *below: str, parts: dict[str, Column] | None = None) -> str:
    """Write lines as gzip text and return the folder."""
    path = "/".join([work_dir(t.spark, "landed"), *below])
    out = df.select(line.alias("value"), *[c.alias(n) for n, c in (parts or {}).items()])
    if parts:
        out = out.hint("rebalance", *[F.col(n) for n in parts])
    writer = out.write.option("compression", "gzip")
    (writer.partitionBy(*parts) if parts else writer).text(path)
    return path


@query(
    "scan_events",
    "SELECT k = 13 AS malformed, "
    + ", ".join(f"CASE WHEN k <> 13 THEN {c} END AS {c}" for c in WIRE if c != "duration")
    + ", CASE WHEN k <> 13 THEN TRY_CAST(duration AS DOUBLE) END AS duration FROM wire",
)
def scan_events(t: Telemetry) -> DataFrame:
    path = land(t, t.wire, event_line(), "raw", "cowrie")
    return logs.scan_events(t.spark, path).select(
        "malformed", *WIRE[:-1], F.col("duration").try_cast("double").alias("duration")
    )


_PROXY_SQL = """SELECT ts, ts_us, client_ip, client_port, frontend_port,
  {0} AS duration, bytes_uploaded, bytes_downloaded, status FROM px WHERE {1}"""


@query("scan_proxy", _PROXY_SQL.format("CASE WHEN duration = 7 THEN 0 ELSE duration END", "duration NOT IN (5, 6)"))
def scan_proxy(t: Telemetry) -> DataFrame:
    return logs.scan_proxy(t.spark, land(t, t.proxies, proxy_line(), "raw", "haproxy"))


@query("scan_proxy_text", _PROXY_SQL.format("duration", "duration <> 8"))
def scan_proxy_text(t: Telemetry) -> DataFrame:
    """Syslog lines; the ones with an IPv6 client do not match the format."""
    c = F.col
    client = F.when(c("duration") == 8, F.lit("2001:db8::7")).otherwise(c("client_ip"))
    line = F.concat(
        c("ts"), F.lit(" edge haproxy[77]: client="), client, F.lit(":"), c("client_port"), F.lit(" frontend_port="),
        c("frontend_port"), F.lit(" duration=+"), c("duration"), F.lit(" bytes_uploaded=+"), c("bytes_uploaded"),
        F.lit(" bytes_downloaded="), c("bytes_downloaded"), F.lit(" status="), c("status"),
    )
    return logs.scan_proxy(t.spark, land(t, t.proxies, line, "raw", "haproxy"), text=True)


def _land_both(t: Telemetry) -> list[str]:
    day = F.substring("ts", 1, 10)
    events = t.wire.join(t.events.select("event_id", "ts", F.col("sensor").alias("host")), "event_id")
    return [
        land(t, events, event_line(), "raw", "cowrie", parts={"date": day, "host": F.col("host")}),
        land(t, t.proxies, proxy_line(), "raw", "haproxy", parts={"date": day, "host": F.lit("edge")}),
    ]


@query(
    "route_sources",
    """SELECT 'event' AS kind, substr(ts, 1, 10) AS date, sensor AS host, count(*) AS lines FROM hp GROUP BY ALL
UNION ALL SELECT 'proxy', substr(ts, 1, 10), 'edge', count(*) FROM px GROUP BY ALL""",
)
def route_sources(t: Telemetry) -> DataFrame:
    routed = logs.route_sources(logs.read_lines(t.spark, _land_both(t)))
    return routed.groupBy("kind", "date", "host").agg(F.count(F.lit(1)).alias("lines"))


@query("scan_partitioned", "SELECT 'event' AS kind, substr(ts, 1, 10) AS date, sensor AS host, count(*) AS lines FROM hp WHERE substr(ts, 1, 10) = '2024-01-17' GROUP BY ALL")
def scan_partitioned(t: Telemetry) -> DataFrame:
    """One day of a landing folder: no other day's folder is opened."""
    routed = logs.read_partitioned(t.spark, _land_both(t)[0]).filter(F.col("date") == "2024-01-17")
    return routed.groupBy("kind", "date", "host").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "ingest_audit",
    f"""SELECT kind, count(*) AS lines, count(*) FILTER (ok) AS validated, count(*) FILTER (ok) AS written,
  count(*) FILTER (NOT ok) AS errors FROM (
  SELECT unnest(['event', '*']) AS kind, k <> 13 AND {_VALID} AS ok FROM wire
  UNION ALL SELECT unnest(['proxy', '*']), duration NOT IN (5, 6) FROM px) GROUP BY kind""",
)
def ingest_audit(t: Telemetry) -> DataFrame:
    """Audit rows summed per source kind, with the grand total."""
    audit = logs.ingest_audit(logs.read_lines(t.spark, _land_both(t)))
    kind = F.when(F.col("object_path") == "*", "*").otherwise(logs.source_kind(F.col("object_path")))
    return audit.groupBy(kind.alias("kind")).agg(
        *[F.sum(c).alias(c) for c in ("lines", "validated", "written", "errors")]
    )


@query(
    "scan_json_logs",
    """SELECT broken, CASE WHEN NOT broken THEN event_type END AS event_type, CASE WHEN NOT broken THEN src_ip END AS src_ip,
  CASE WHEN NOT broken THEN dest_ip END AS dest_ip, CASE WHEN NOT broken THEN severity END AS severity,
  CASE WHEN NOT broken THEN signature END AS signature
FROM (SELECT *, event_type = 'dns' AND signature = 'ET INFO Ping' AS broken FROM ids)""",
)
def scan_json_logs(t: Telemetry) -> DataFrame:
    whole = F.to_json(F.struct("event_type", "src_ip", "dest_ip", F.struct("severity", "signature").alias("alert")))
    broken = (F.col("event_type") == "dns") & (F.col("signature") == "ET INFO Ping")
    path = land(t, t.ids, F.when(broken, F.concat(F.lit("oops "), whole)).otherwise(whole))
    rows = logs.scan_json_logs(
        t.spark,
        path,
        "event_type STRING, src_ip STRING, dest_ip STRING, alert STRUCT<severity: BIGINT, signature: STRING>",
    )
    return rows.select(F.col("json_error").isNotNull().alias("broken"), "event_type", "src_ip", "dest_ip", "alert.*")


@query(
    "scan_feeds",
    """SELECT kind, value, CAST(NULL AS VARCHAR) AS indicator_event_id, CAST(NULL AS BIGINT) AS threat_level,
  CAST(NULL AS VARCHAR) AS info, 'csv' AS feed, 'tlp:white' AS tag FROM ind
UNION ALL SELECT 'ip', value, NULL, NULL, NULL, 'list', 'tlp:white' FROM ind WHERE threat_level <> 4
UNION ALL SELECT 'ip', value, indicator_event_id, threat_level, info, 'events', 'tlp:white' FROM ind
UNION ALL SELECT 'domain', info || '.example', indicator_event_id, threat_level, info, 'events', 'tlp:white' FROM ind""",
)
def scan_feeds(t: Telemetry) -> DataFrame:
    c, ind = F.col, t.indicators
    csv = land(
        t, ind, F.explode(F.array(F.lit("# comment"), F.concat(c("indicator_event_id"), F.lit(","), c("value"))))
    )
    listed = F.when(c("threat_level") == 4, F.concat(F.lit("host "), c("value"))).otherwise(
        F.concat(c("value"), F.lit(" # "), c("info"))
    )
    text = land(t, ind, listed)
    attributes = F.array(
        F.struct(F.lit("ip-dst").alias("type"), c("value").alias("value")),
        F.struct(F.lit("domain").alias("type"), F.concat(c("info"), F.lit(".example")).alias("value")),
    )
    event = F.struct(
        c("indicator_event_id").alias("id"),
        "info",
        c("threat_level").cast("string").alias("threat_level_id"),
        attributes.alias("Attribute"),
    )
    json = land(t, ind, F.to_json(F.struct(event.alias("Event"))))
    return (
        dims.scan_csv_feed(t.spark, csv, "csv", columns="id STRING, ip STRING", value="ip", kind="ip")
        .unionByName(dims.scan_text_feed(t.spark, text, "list"))
        .unionByName(dims.scan_json_feed(t.spark, json, "events"))
    )


@query(
    "load_geo_ranges",
    """SELECT lo, hi, country, asn, asn_org FROM geo
UNION ALL SELECT lo + 256, lo + 511, country, asn, asn_org FROM geo""",
)
def load_geo_ranges(t: Telemetry) -> DataFrame:
    n = F.col("asn").cast("string")
    cidrs = F.array(
        F.concat(F.lit("45."), n, F.lit(".0.0/16")), F.concat(F.lit("45."), n, F.lit(".1.9/24")), F.lit("not/a/cidr")
    )
    pool = F.struct("asn", "asn_org", "country", F.lit(1).alias("weight"), cidrs.alias("cidrs"))
    path = land(t, t.geo_ranges, F.to_json(F.struct(F.array(pool).alias("pools"))))
    return dims.load_geo_ranges(t.spark, path, multi_line=False)


@query(
    "geo_enrich_v6",
    """SELECT event_id, CASE WHEN geo.asn IS NOT NULL AND v6 AND net = 6 THEN 'ZZ' ELSE country END AS country, geo.asn, asn_org
FROM (SELECT event_id, event_id % 3 <> 2 AS v6, CAST(split_part(src_ip, '.', 2) AS BIGINT) AS a, CAST(split_part(src_ip, '.', 3) AS BIGINT) AS net
  FROM hp WHERE src_ip LIKE '45.%') e LEFT JOIN geo ON e.a = geo.asn""",
)
def geo_enrich_v6(t: Telemetry) -> DataFrame:
    """Addresses as IPv6 in long upper-case and short form and as IPv4-mapped text; a /64 of another country lies in each /48."""
    part = F.split("src_ip", r"\.")
    a, b, c = (part[i].cast("int") for i in (1, 2, 3))
    long, short = (F.format_string(f, a, b, c) for f in ("2001:0DB8:%04X:%04X:0000:0000:0000:%04X", "2001:db8:%x:%x::%x"))
    kind = F.col("event_id") % 3
    text = F.when(kind == 0, long).when(kind == 1, short).otherwise(F.concat(F.lit("::ffff:"), "src_ip"))
    events = t.events.filter(F.col("src_ip").startswith("45.")).select("event_id", text.alias("src_ip"))
    n = F.col("asn").cast("int")
    wide = F.array(F.concat(F.lit("45."), n.cast("string"), F.lit(".0.0/16")), F.format_string("2001:db8:%x::/48", n), F.lit("2001:db8::/129"))
    pool = lambda country, cidrs: F.struct("asn", "asn_org", country.alias("country"), F.lit(1).alias("weight"), cidrs.alias("cidrs"))
    pools = F.array(pool(F.col("country"), wide), pool(F.lit("ZZ"), F.array(F.format_string("2001:db8:%x:6::/64", n))))
    path = land(t, t.geo_ranges, F.to_json(F.struct(pools.alias("pools"))))
    return geo_enrich(events, dims.load_address_ranges(t.spark, path, multi_line=False)).select("event_id", "country", "asn", "asn_org")


@query("load_dictionary", "SELECT DISTINCT p_name AS word FROM part")
def load_dictionary(t: Telemetry) -> DataFrame:
    parts = t.table("part")
    lines = F.explode(
        F.array(F.lit("# header"), F.concat(F.lit("  "), "p_name", F.lit("\t")), F.lit(""), F.concat(F.lit("#"), "p_name"))
    )
    return dims.load_dictionary(t.spark, land(t, parts, lines))


@query(
    "sink_events",
    """SELECT session, ts, eventid, event_id, CASE WHEN eventid = 'cowrie.login.failed' THEN 'replay' ELSE sensor END
  AS sensor, substr(ts, 1, 10) AS day FROM hp""",
)
def sink_events(t: Telemetry) -> DataFrame:
    """All events, then failed logins again with another sensor name, then the same replay once more, by number and anew."""
    path = work_dir(t.spark, "events")
    rows = t.events.select("session", "ts", "eventid", "event_id", "sensor")
    replay = rows.filter(F.col("eventid") == "cowrie.login.failed").withColumn("sensor", F.lit("replay"))
    for number, batch in ((0, rows), (1, replay), (1, replay), (2, replay)):
        sinks.sink_events(batch, path, batch=number)
    return event_store(t.spark, path).read()


def _stored_in_batches(t: Telemetry) -> AppendTable:
    """All events in three batches by hash, the second once more with other addresses for failed logins and then with their own."""
    path = work_dir(t.spark, "events")
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    other = F.when(F.col("eventid") == "cowrie.login.failed", F.lit("203.0.113.99")).otherwise(F.col("src_ip"))
    second = t.stored.filter(part == 1)
    for batch in (t.stored.filter(part == 0), second.withColumn("src_ip", other), t.stored.filter(part == 2), second):
        sinks.sink_events(batch, path)
    return event_store(t.spark, path)


@query("store_session_log", SQL["session_log"])
def store_session_log(t: Telemetry) -> DataFrame:
    """The session log from the event store: the index names the files."""
    return reports.session_log(_stored_in_batches(t).rows_of("session", ["u6-1"]), "u6-1")


@query("store_ip_history", SQL["ip_history"])
def store_ip_history(t: Telemetry) -> DataFrame:
    """The history of an address from the event store, as of its last batches."""
    return reports.ip_history(_stored_in_batches(t).rows_of("src_ip", ["45.6.6.7"], through="session"), "45.6.6.7")


@query(
    "export_manifest",
    """SELECT day, count(*) AS rows, CAST(sum(('0x' || substr(md5(line), 1, 8))::BIGINT) AS BIGINT) AS checksum FROM (
  SELECT substr(ts, 1, 10) AS day, '{"ts":"' || ts || '","session":"' || session || '","eventid":"' || eventid
    || '","src_ip":"' || src_ip || '"}' AS line FROM hp) GROUP BY day""",
)
def export_manifest(t: Telemetry) -> DataFrame:
    return sinks.export_partitioned(t.events, work_dir(t.spark, "export"), ("ts", "session", "eventid", "src_ip"))


@query(
    "sink_routed",
    f"""SELECT category, strftime(make_timestamp(ts_us), '%Y-%m-%d') AS date, count(*) AS records
FROM ({UNIFIED_SQL}) GROUP BY ALL""",
)
def sink_routed(t: Telemetry) -> DataFrame:
    path = work_dir(t.spark, "routed")
    sinks.sink_routed(unified(t).withColumn("event_time", F.timestamp_micros("ts_us")), path)
    stored = t.spark.read.parquet(path)
    return stored.groupBy("category", F.col("date").cast("string").alias("date")).agg(F.count(F.lit(1)).alias("records"))
