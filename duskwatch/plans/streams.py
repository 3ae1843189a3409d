"""Queries on streams: telemetry is landed, a streaming job drains it, the result is read back.

A closing marker far after the last row moves the watermark past all real rows, as the
next day's traffic would; it is taken out of the result.
"""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.functions.net import LOOPBACK
from duskwatch.functions.timefns import DAY_US
from duskwatch.operators import correlate as C
from duskwatch.operators.rules import ssh_to_home
from duskwatch.plans.counts import NOW, SPAN
from duskwatch.plans.landed import event_line, land
from duskwatch.plans.registry import query
from duskwatch.plans.rows import _VALID
from duskwatch.session import work_dir
from duskwatch.sources.logs import read_lines
from duskwatch.sources.store import event_store
from duskwatch.sources.telemetry import Telemetry
from duskwatch.streaming import counters as S
from duskwatch.streaming import rolling as R
from duskwatch.streaming import stateful as K
from duskwatch.streaming.correlate import correlated, maintain_correlation
from duskwatch.streaming.ingest import ingest_events
from duskwatch.streaming.inherit import inherited, maintain_inheritance
from duskwatch.streaming.resolve import ingest_resolved
from duskwatch.streaming.run import drain_to_files, landing_files, stream_parquet, use_rocksdb

MARKER_US = 4_000_000_000_000_000  # in the year 2096


def landed_stream(t: Telemetry, df: DataFrame, *, marker: bool = True) -> DataFrame:
    """Land a frame as parquet and stream it with its ``event_time``."""
    path = work_dir(t.spark, "stream-in")
    timed = df.withColumn("event_time", F.timestamp_micros("ts_us"))
    timed.write.parquet(path)
    if marker:
        blank = {c: F.lit(None).cast(k) for c, k in timed.dtypes}
        blank |= {"ts_us": F.lit(MARKER_US), "event_time": F.timestamp_micros(F.lit(MARKER_US))}
        blank |= {c: F.lit(LOOPBACK) for c in ("src_ip",) if c in timed.columns}
        t.spark.range(1).select(*[blank[c].alias(c) for c in timed.columns]).write.mode("append").parquet(path)
    return stream_parquet(t.spark, path)


def result(t: Telemetry, stream: DataFrame) -> DataFrame:
    use_rocksdb(t.spark)
    out, checkpoint = work_dir(t.spark, "stream-out"), work_dir(t.spark, "stream-checkpoint")
    drain_to_files(stream, out, checkpoint)
    return t.spark.read.schema(stream.schema).parquet(out)


def _ingested(t: Telemetry) -> tuple[str, str]:
    use_rocksdb(t.spark)
    raw = land(t, t.wire, event_line(), "raw", "cowrie")
    store, quarantine = work_dir(t.spark, "store"), work_dir(t.spark, "quarantine")
    ingest_events(
        t.spark,
        raw,
        geo_ranges=t.geo_ranges,
        dictionary=t.dictionary,
        store=store,
        quarantine=quarantine,
        checkpoint=work_dir(t.spark, "checkpoint"),
    )
    return store, quarantine


@query(
    "stream_ingest",
    f"""SELECT w.session, w.timestamp AS ts, w.eventid, w.src_ip, s.country, s.password, s.password_raw
FROM (SELECT * FROM wire WHERE k <> 13 AND {_VALID}) w JOIN stored s ON w.event_id = s.event_id""",
)
def stream_ingest(t: Telemetry) -> DataFrame:
    store, _ = _ingested(t)
    return event_store(t.spark, store).read().select(
        "session", "ts", "eventid", "src_ip", "country", "password", "password_raw"
    )


@query(
    "stream_quarantine",
    f"""SELECT CASE WHEN k = 13 THEN 'not_json' ELSE 'rules' END AS reason, count(*) AS lines
FROM wire WHERE k = 13 OR NOT ({_VALID}) GROUP BY ALL""",
)
def stream_quarantine(t: Telemetry) -> DataFrame:
    _, quarantine = _ingested(t)
    reason = F.when(F.array_contains("failed_rules", "not_json"), "not_json").otherwise("rules")
    return t.spark.read.parquet(quarantine).groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "stream_dedup",
    """SELECT change_id, count(*) AS copies FROM (
  SELECT DISTINCT 'c' || event_id AS change_id FROM hp WHERE k <> 3
  UNION ALL SELECT 'none' FROM hp, (VALUES (1), (2)) WHERE k = 3) GROUP BY change_id""",
)
def stream_dedup(t: Telemetry) -> DataFrame:
    """Every change is delivered twice; changes without an id are all kept."""
    e = t.events.select(
        "ts_us", F.when(F.col("k") != 3, F.concat(F.lit("c"), F.col("event_id").cast("string"))).alias("change_id")
    )
    stream = S.dedup_stream(landed_stream(t, e.unionByName(e), marker=False), "change_id", "event_time")
    return (
        result(t, stream)
        .groupBy(F.coalesce("change_id", F.lit("none")).alias("change_id"))
        .agg(F.count(F.lit(1)).alias("copies"))
    )


_CHANGE_FIELDS = {"session": "string", "eventid": "string", "dst_port": "bigint", "tags": "string"}


@query(
    "stream_change_feed",
    """SELECT 'c' || event_id AS change_id, CASE WHEN k % 10 = 1 THEN 'skipped' WHEN k % 10 = 2 THEN 'skipped'
    WHEN k % 10 = 4 THEN 'skipped_non_event' ELSE 'processed' END AS outcome,
  CASE WHEN k % 10 <> 2 THEN session END AS session, CASE WHEN k % 10 <> 2 THEN eventid END AS eventid,
  CASE WHEN k % 10 <> 2 THEN dst_port END AS dst_port,
  CASE WHEN k % 10 <> 2 THEN '["' || sensor || '","' || k || '"]' END AS tags FROM hp""",
)
def stream_change_feed(t: Telemetry) -> DataFrame:
    c, kind = F.col, F.col("k") % 10

    def tagged(tag: str, value):
        return F.to_json(F.struct(value.alias(tag)))

    def attribute(name: str, body):
        return F.concat(F.lit(f'"{name}":'), body)

    tags = F.concat(
        F.lit('{"L":['), tagged("S", c("sensor")), F.lit(","), tagged("N", c("k").cast("string")), F.lit("]}")
    )
    port = F.when(c("dst_port").isNull(), F.lit('{"NULL":true}')).otherwise(tagged("N", c("dst_port").cast("string")))
    image = F.concat(
        F.lit("{"),
        F.concat_ws(
            ",",
            attribute("type", tagged("S", F.when(kind == 4, F.lit("RANK")).otherwise(F.lit("EVENT")))),
            attribute("session", tagged("S", c("session"))),
            attribute("eventid", tagged("S", c("eventid"))),
            attribute("dst_port", port),
            attribute("tags", tags),
        ),
        F.lit("}"),
    )
    name = F.when(kind == 1, "REMOVE").when(kind == 5, "MODIFY").otherwise("INSERT")
    record = F.concat(
        F.lit('{"eventID":"c'), c("event_id").cast("string"), F.lit('","eventName":"'), name, F.lit('","dynamodb":{'),
        F.when(kind != 2, F.concat(F.lit('"NewImage":'), image)).otherwise(F.lit("")), F.lit("}}"),
    )
    lines = read_lines(t.spark, land(t, t.events, record, "changes"), streaming=True)
    return result(t, S.decode_changes(lines, _CHANGE_FIELDS))


def _counter_table(t: Telemetry) -> str:
    """All eight dimensions: seven from the stream, techniques from the stored events."""
    use_rocksdb(t.spark)
    path = work_dir(t.spark, "hourly")
    stored = t.stored.select("ts_us", "username", "password", "country", "asn", "eventid", "input", "dst_port")
    S.maintain_hourly_counts(landed_stream(t, stored, marker=False), path, work_dir(t.spark, "checkpoint"))
    S.refresh_technique_counts(t.events, path)
    return path


@query("stream_hourly", "SELECT * FROM counters")
def stream_hourly(t: Telemetry) -> DataFrame:
    return S.stored_counters(t.spark, _counter_table(t)).select("bucket", "dimension", "value", "count")


@query(
    "stream_corr",
    """SELECT event_id, ts_us, candidates, CASE candidates WHEN 0 THEN 'missed' WHEN 1 THEN 'matched' ELSE 'ambiguous' END
  AS status, CASE WHEN candidates = 1 THEN ip ELSE '127.0.0.1' END AS src_ip FROM (
  SELECT e.event_id, e.ts_us, count(p.ts_us) AS candidates, min(p.client_ip) AS ip
  FROM tun e LEFT JOIN px p ON p.ts_us BETWEEN e.ts_us - 600000000 AND e.ts_us - 1000000
  WHERE e.src_ip = '127.0.0.1' GROUP BY ALL)""",
)
def stream_corr(t: Telemetry) -> DataFrame:
    """Over the span of the batch queries, where all three outcomes occur."""
    events = landed_stream(t, t.tunnelled.select("event_id", "ts_us", "src_ip"))
    proxies = landed_stream(t, t.proxies.select("ts_us", "client_ip"))
    path = work_dir(t.spark, "correlated")
    maintain_correlation(events, proxies, path, work_dir(t.spark, "checkpoint"), delay_us=900_000_000, chunk_us=DAY_US, **SPAN)
    return correlated(t.spark, path).select("event_id", "ts_us", "candidates", "status", "src_ip")


@query(
    "stream_resolve",
    """SELECT session, ts, eventid, b.src_ip, coalesce(status, 'direct') AS status, n AS candidates, country, asn, asn_org
FROM bwd b LEFT JOIN geo ON b.src_ip LIKE '45.%' AND CAST(split_part(b.src_ip, '.', 2) AS BIGINT) = geo.asn""",
)
def stream_resolve(t: Telemetry) -> DataFrame:
    """Events and early proxy rows land, then late proxy rows: what the store then holds."""
    c = F.col
    event = F.to_json(
        F.struct(
            "eventid", c("ts").alias("timestamp"), "src_ip", "session", "sensor", "protocol", c("src_port").cast("string").alias("src_port"),
            c("dst_port").cast("string").alias("dst_port"), "username", "password", "input", "url", "shasum", c("duration").cast("string").alias("duration"),
        )
    )
    row = F.to_json(
        F.struct(
            F.replace("ts", F.lit("+00:00"), F.lit("Z")).alias("time"), "client_ip", "client_port", "frontend_port",
            c("duration").cast("string").alias("duration"), "bytes_uploaded", "bytes_downloaded", "status",
        )
    )
    base = work_dir(t.spark, "resolve")
    paths = {name: f"{base}/{name}" for name in ("store", "proxies", "quarantine", "checkpoint")}

    def landed(df: DataFrame, line, below: str) -> None:
        # gzip text is not split, so as many tasks read the lines as there are files
        spread = df.repartition(landing_files(t.spark), F.xxhash64("event_id", "ts"))
        spread.select(line.alias("value")).write.option("compression", "gzip").text(f"{base}/raw/{below}")
        if below != "cowrie":
            ingest_resolved(t.spark, f"{base}/raw", geo_ranges=t.geo_ranges, dictionary=t.dictionary, **paths, **SPAN)

    landed(t.tunnelled, event, "cowrie")
    landed(t.proxies.filter(~c("late")), row, "haproxy/early")
    landed(t.proxies.filter("late"), row, "haproxy/late")
    return event_store(t.spark, paths["store"]).read().select(
        "session", "ts", "eventid", "src_ip", F.coalesce("correlation_status", F.lit("direct")).alias("status"),
        F.coalesce("correlation_candidate_count", F.lit(0)).alias("candidates"), "country", "asn", "asn_org",
    )


@query("stream_sessions", "SELECT * FROM closings")
def stream_sessions(t: Telemetry) -> DataFrame:
    """Several micro-batches that cut sessions by a hash of the event, so they come out of order."""
    landed, out = work_dir(t.spark, "session-events"), work_dir(t.spark, "sessions")
    rows = t.events.select("session", "ts", "eventid", "username", "duration")
    rows.repartition(4, F.xxhash64("ts", "eventid")).write.parquet(landed)
    S.maintain_session_summaries(stream_parquet(t.spark, landed, files_per_batch=1), out, work_dir(t.spark, "checkpoint"))
    return S.session_summary(t.spark, out)


@query("stream_inherit", "SELECT event_id, session, src_ip, coalesce(status, 'direct') AS status FROM inh")
def stream_inherit(t: Telemetry) -> DataFrame:
    forward = C.correlate_forward(t.tunnelled, t.proxies, list_candidates=False, **SPAN).select(
        "event_id", "session", "ts_us", "eventid", "src_ip", F.col("correlation_status").alias("status")
    )
    path = work_dir(t.spark, "inherited")
    maintain_inheritance(landed_stream(t, forward, marker=False), path, work_dir(t.spark, "checkpoint"))
    return inherited(t.spark, path).select("event_id", "session", "src_ip", F.coalesce("status", F.lit("direct")).alias("status"))


@query("stream_alerts", "SELECT source_event, src_ip, ts_us, username, n_events, n_distinct FROM rolling WHERE n_events >= 3 OR n_distinct >= 3")
def stream_alerts(t: Telemetry) -> DataFrame:
    path = work_dir(t.spark, "rolling")
    R.maintain_rolling_counts(
        landed_stream(t, t.failed), path, work_dir(t.spark, "checkpoint"), width_us=86_400_000_000, keep="n_events >= 3 OR n_distinct >= 3"
    )
    return R.rolling_counts(t.spark, path).select("source_event", "src_ip", "ts_us", "username", "n_events", "n_distinct")


@query("stream_threshold", "SELECT * FROM threshold")
def stream_threshold(t: Telemetry) -> DataFrame:
    flows = landed_stream(t, t.flows.filter(ssh_to_home()).select("src_ip", "ts_us"))
    return result(t, K.threshold_stream(flows, count=2, seconds=604_800))


@query(
    "scheduled_rebuild",
    """SELECT 'rank' AS kind, "window" || ':' || dimension || ':' || value AS name, count FROM ranks
UNION ALL SELECT 'summary', day, total_events FROM days WHERE day IN ('2024-01-29', '2024-01-30')""",
)
def scheduled_rebuild(t: Telemetry) -> DataFrame:
    """Ranks from the stored counters, then yesterday's and today's summary."""
    counters, ranks, days = _counter_table(t), work_dir(t.spark, "ranks"), work_dir(t.spark, "days")
    S.rebuild_ranks(t.spark, counters, ranks, NOW)
    for day in ("2024-01-29", "2024-01-30"):
        S.rebuild_summary(t.events, days, day)
    ranked = t.spark.read.parquet(ranks).select(
        F.lit("rank").alias("kind"), F.concat_ws(":", "window", "dimension", "value").alias("name"), "count"
    )
    summaries = t.spark.read.parquet(days).select(
        F.lit("summary").alias("kind"), F.col("day").cast("string").alias("name"), F.col("total_events").alias("count")
    )
    return ranked.unionByName(summaries)
