"""Queries on joins, correlation, counters, ranks and reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.operators import correlate as C
from duskwatch.operators import rank as K
from duskwatch.operators import reports as R
from duskwatch.operators import rollup as A
from duskwatch.operators import triage as G
from duskwatch.operators.enrich import classify_passwords, geo_enrich
from duskwatch.operators.joins import either_endpoint_join
from duskwatch.operators.sweep import nearest_preceding
from duskwatch.operators.wordlist import LEET, NUMBER_SUFFIXES, SYMBOL_SUFFIXES, YEAR_SUFFIXES, expand_wordlist
from duskwatch.plans.country_codes import COUNTRY_CODES
from duskwatch.plans.registry import query
from duskwatch.plans.rows import NOW_US, PUBLIC_SQL
from duskwatch.plans.views import sql_list
from duskwatch.session import stage
from duskwatch.sources.telemetry import Telemetry

NOW = datetime(2024, 1, 31)
# The sample events are sparse: 10 minutes with a floor of 1 second instead of 500 ms and 1 ms.
SPAN = {"window_us": 600_000_000, "floor_us": 1_000_000}
WEEK = ("2024-01-24 01:00:00", "2024-01-31 01:00:00")
DAY = ("2024-01-30 01:00:00", "2024-01-31 01:00:00")


# ---- joins and enrichment


@query("geo_enrich", "SELECT event_id, src_ip, country, asn, asn_org FROM stored")
def geo(t: Telemetry) -> DataFrame:
    return geo_enrich(t.events, t.geo_ranges).select("event_id", "src_ip", "country", "asn", "asn_org")


@query(
    "geo_overlap",
    """SELECT event_id, CASE WHEN (event_id % 256) < 128 AND country IS NOT NULL THEN 'n' || asn ELSE country END AS country
FROM (SELECT h.event_id, country, asn FROM hp h LEFT JOIN geo
  ON 754974720 + (h.user_id % 27) * 65536 + h.event_id % 256 BETWEEN lo AND hi)""",
)
def geo_overlap(t: Telemetry) -> DataFrame:
    """Nested ranges: the first half of the first /24 of each network has a range of its own."""
    narrow = t.geo_ranges.select(
        "lo", (F.col("lo") + 127).alias("hi"), F.concat(F.lit("n"), F.col("asn").cast("string")).alias("country"), "asn",
        "asn_org",
    )
    host = F.concat(
        F.lit("45."), (F.col("user_id") % 27).cast("string"), F.lit(".0."), (F.col("event_id") % 256).cast("string")
    )
    return geo_enrich(t.events.withColumn("src_ip", host), t.geo_ranges.unionByName(narrow)).select("event_id", "country")


@query("password_classify", "SELECT event_id, password, password_raw FROM stored")
def password_classify(t: Telemetry) -> DataFrame:
    return classify_passwords(t.events, t.dictionary).select("event_id", "password", "password_raw")


def ioc(t: Telemetry) -> DataFrame:
    return either_endpoint_join(t.flows, t.indicators.drop("kind"))


@query("ioc_match", "SELECT flow_id, src_ip, dest_ip, indicator_event_id, threat_level, info, feed, matched_on FROM ioc")
def ioc_match(t: Telemetry) -> DataFrame:
    return ioc(t).select(
        "flow_id", "src_ip", "dest_ip", "indicator_event_id", "threat_level", "info", "feed", "matched_on"
    )


_CODES_SQL = ", ".join(f"('{a}', '{n}', '{name}')" for a, n, name in COUNTRY_CODES)


def country_codes(t: Telemetry) -> DataFrame:
    return t.spark.createDataFrame(list(COUNTRY_CODES), "alpha2 string, numeric string, name string")


@query(
    "choropleth_feed",
    f"""SELECT *, round(count / max_count, 6) AS intensity FROM (
  SELECT numeric, name, alpha2, count, max(count) OVER () AS max_count, count(*) OVER () AS countries
  FROM ranks JOIN (SELECT * FROM (VALUES {_CODES_SQL}) AS c(alpha2, numeric, name)) ON upper(value) = alpha2
  WHERE "window" = '24H' AND dimension = 'country' AND rank <= 20)""",
)
def choropleth_feed(t: Telemetry) -> DataFrame:
    ranked = R.top_list(ranks(t, DAY), "country", "24h", 20)
    return K.relative_intensity(ranked, country_codes(t))


def rule_table(t: Telemetry) -> DataFrame:
    from duskwatch.operators.rules import MULTI_EVENT_RULES, RULES

    rows = [(r.rule_id, r.technique) for r in RULES] + [(r[0], r[2]) for r in MULTI_EVENT_RULES]
    return t.spark.createDataFrame(rows, "rule_id string, technique string")


@query(
    "coverage_gaps",
    """SELECT tactic, technique, CASE WHEN bool_and(covered) OVER w THEN 'covered' WHEN NOT bool_or(covered) OVER w THEN 'none'
  ELSE 'partial' END AS coverage, covered, (SELECT count(*) FROM alerts a WHERE a.technique = hit.technique) AS firings
FROM (SELECT c.tactic, c.technique, bool_or(r.technique IS NOT NULL) AS covered
  FROM catalogue c LEFT JOIN ruletable r ON r.technique = c.technique GROUP BY ALL) hit WINDOW w AS (PARTITION BY tactic)""",
)
def coverage_gaps(t: Telemetry) -> DataFrame:
    """Every technique with its tactic's tier and how often its rules fired; gaps have no rule and no firings."""
    from duskwatch.plans.alerts import all_alerts

    catalogue = t.spark.createDataFrame(list(G.TECHNIQUE_CATALOGUE), "tactic string, technique string")
    fired = all_alerts(t).groupBy("technique").agg(F.count(F.lit(1)).alias("firings"))
    tiers = G.technique_coverage(catalogue, rule_table(t)).join(fired, "technique", "left")
    return tiers.select("tactic", "technique", "coverage", "covered", F.coalesce("firings", F.lit(0)).alias("firings"))


def _leet_sql() -> str:
    full = "word"
    singles = []
    for a, b in LEET:
        full = f"replace({full}, '{a}', '{b}')"
        swap = f"replace(word, '{a}', '{b}')"
        singles.append(f"SELECT {swap} FROM words WHERE contains(word, '{a}')")
        singles.append(f"SELECT {_title(swap)} FROM words WHERE contains(word, '{a}')")
    multi = [f"SELECT {full} || '{e}' FROM words" for e in ("", "!", "1", "123")]
    return " UNION ALL ".join(singles + multi)


def _title(c: str) -> str:
    """Upper case after each non-letter, lower case elsewhere."""
    return (
        f"list_aggregate(list_transform(range(1, length({c}) + 1), lambda i: CASE WHEN i = 1 OR "
        f"NOT regexp_matches(substr(lower({c}), i - 1, 1), '[a-z]') THEN upper(substr({c}, i, 1)) "
        f"ELSE lower(substr({c}, i, 1)) END), 'string_agg', '')"
    )


_ENDS = (
    [""]
    + [g + n for n in NUMBER_SUFFIXES for g in ("", "@")]
    + list(SYMBOL_SUFFIXES)
    + ["123" + s for s in SYMBOL_SUFFIXES]
    + [g + y for y in YEAR_SUFFIXES for g in ("", "@")]
)
_REPEAT = ("small", "red")


@query(
    "expand_wordlist",
    f"""WITH words AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part),
forms AS (SELECT word AS form FROM words UNION SELECT {_title('word')} FROM words)
SELECT DISTINCT word FROM (
  SELECT form || unnest({sql_list(_ENDS)}) AS word FROM forms
  UNION ALL {_leet_sql()}
  UNION ALL SELECT word || unnest({sql_list([s + r for r in _REPEAT for s in ('', '_', '@', '/')])}) FROM words
  WHERE word IN ('small', 'red'))
WHERE trim(word) <> ''""",
)
def wordlist(t: Telemetry) -> DataFrame:
    words = t.table("part").select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    return expand_wordlist(words, _REPEAT)


# ---- correlation

_CORR_SQL = """SELECT event_id, session, src_ip, coalesce(status, 'direct') AS status, n AS candidates, {0} FROM {1}"""


def _corr_columns(df: DataFrame, *more) -> DataFrame:
    return df.select(
        "event_id",
        "session",
        "src_ip",
        F.coalesce("correlation_status", F.lit("direct")).alias("status"),
        F.coalesce("correlation_candidate_count", F.lit(0).cast("bigint")).alias("candidates"),
        *more,
    )


@query("corr_forward", _CORR_SQL.format("eventid", "fwd"))
def corr_forward(t: Telemetry) -> DataFrame:
    return _corr_columns(C.correlate_forward(t.tunnelled, t.proxies, list_candidates=False, **SPAN), F.col("eventid"))


@query(
    "corr_candidates",
    """SELECT e.ts_us, count(*) AS n, min(p.ts_us) AS oldest_us, max(p.ts_us) AS newest_us
FROM (SELECT DISTINCT ts_us FROM tun WHERE src_ip = '127.0.0.1') e
JOIN px p ON p.ts_us BETWEEN e.ts_us - 600000000 AND e.ts_us - 1000000 GROUP BY e.ts_us HAVING count(*) > 1""",
)
def corr_candidates(t: Telemetry) -> DataFrame:
    return C.candidate_spans(t.tunnelled, t.proxies, **SPAN)


@query("corr_inherit", _CORR_SQL.format("eventid", "inh"))
def corr_inherit(t: Telemetry) -> DataFrame:
    forward = stage(C.correlate_forward(t.tunnelled, t.proxies, list_candidates=False, **SPAN), "forward")
    return _corr_columns(C.inherit_matches(forward), F.col("eventid"))


def _early(t: Telemetry) -> DataFrame:
    return t.proxies.filter(~F.col("late"))


def _late(t: Telemetry) -> DataFrame:
    return t.proxies.filter("late")


def _before_late_rows(t: Telemetry) -> DataFrame:
    forward = stage(C.correlate_forward(t.tunnelled, _early(t), list_candidates=False, **SPAN), "forward")
    return stage(C.inherit_matches(forward), "inherited")


@query("corr_backward", _CORR_SQL.format("eventid", "bwd"))
def corr_backward(t: Telemetry) -> DataFrame:
    return _corr_columns(C.correlate_backward(_before_late_rows(t), _late(t), **SPAN), F.col("eventid"))


@query(
    "corr_resolve",
    """SELECT event_id, session, b.src_ip, coalesce(status, 'direct') AS status, n AS candidates, country, asn, asn_org
FROM bwd b LEFT JOIN geo ON b.src_ip LIKE '45.%' AND CAST(split_part(b.src_ip, '.', 2) AS BIGINT) = geo.asn""",
)
def corr_resolve(t: Telemetry) -> DataFrame:
    out = C.resolve(t.tunnelled, _early(t), _late(t), t.geo_ranges, list_candidates=False, **SPAN)
    return _corr_columns(out, "country", "asn", "asn_org")


@query(
    "corr_metrics",
    """SELECT 'candidate_count' AS metric, CAST(n AS VARCHAR) AS label, count(*) AS n FROM efwd
WHERE sensor_ip = '127.0.0.1' GROUP BY ALL
UNION ALL SELECT 'event_status', status, count(*) FROM einh WHERE status IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'backward_outcome', CASE WHEN owners = 0 THEN 'no_candidates' WHEN owners > 1 THEN 'ambiguous'
    WHEN EXISTS (SELECT 1 FROM einh e WHERE e.session = p.session
      AND (e.status IS NULL OR e.status IN ('missed', 'ambiguous'))) THEN 'matched_new'
    ELSE 'matched_skipped_already_matched' END, count(*)
  FROM targets p GROUP BY ALL""",
)
def corr_metrics(t: Telemetry) -> DataFrame:
    forward = stage(C.correlate_forward(t.tunnelled, _early(t), list_candidates=False, **SPAN), "forward")
    return C.correlation_outcomes(forward, stage(C.inherit_matches(forward), "inherited"), _late(t), **SPAN)


@query(
    "corr_ambiguous_share",
    """SELECT tunnelled, ambiguous, round(ambiguous / tunnelled, 6) AS share,
  round(ambiguous / tunnelled, 6) > 0.05 AS over_watch, round(ambiguous / tunnelled, 6) > 0.10 AS over_limit
FROM (SELECT count(*) AS tunnelled, count(*) FILTER (status = 'ambiguous') AS ambiguous FROM fwd WHERE status IS NOT NULL)""",
)
def corr_ambiguous_share(t: Telemetry) -> DataFrame:
    return C.ambiguous_share(C.correlate_forward(t.tunnelled, t.proxies, list_candidates=False, **SPAN))


def latencies(t: Telemetry) -> DataFrame:
    loop = t.tunnelled.filter(F.col("src_ip") == C.LOOPBACK).select("event_id", "ts_us")
    points = t.proxies.select("ts_us")
    return nearest_preceding(loop, points, floor_us=1_000_000).withColumn("delta_us", F.col("ts_us") - F.col("point_us"))


@query(
    "asof_latency",
    """SELECT count(*) AS measured, min(ms) AS min_ms, min(ms) FILTER (rn >= ceil(total * 0.5)) AS p50_ms,
  min(ms) FILTER (rn >= ceil(total * 0.95)) AS p95_ms, max(ms) AS max_ms
FROM (SELECT *, row_number() OVER (ORDER BY ms) AS rn, count(*) OVER () AS total FROM (
  SELECT (ts_us - point_us) // 1000 AS ms FROM nearest WHERE point_us IS NOT NULL))""",
)
def asof_latency(t: Telemetry) -> DataFrame:
    return G.latency_distribution(latencies(t))


_WIDTHS = (200_000, 500_000, 60_000_000, 300_000_000, 600_000_000)


@query(
    "window_sweep",
    f"""SELECT width_us, count(*) AS events, count(*) FILTER (ts_us - point_us <= width_us) AS hits,
  round(count(*) FILTER (ts_us - point_us <= width_us) / count(*), 6) AS hit_rate
FROM nearest, (SELECT CAST(unnest({sql_list(_WIDTHS)}) AS BIGINT) AS width_us) GROUP BY width_us""",
)
def window_sweep(t: Telemetry) -> DataFrame:
    return G.window_sweep(latencies(t), _WIDTHS)


# ---- counters and summaries


@query("hourly_counts", "SELECT * FROM hourly")
def hourly_counts(t: Telemetry) -> DataFrame:
    return A.hourly_counts(t.stored)


@query("command_counts", "SELECT * FROM commands")
def command_counts(t: Telemetry) -> DataFrame:
    return A.command_counts(t.events)


@query("proxy_port_counts", "SELECT * FROM relays")
def proxy_port_counts(t: Telemetry) -> DataFrame:
    return A.proxy_port_counts(t.events)


@query("session_summary", "SELECT * FROM closings")
def session_summary(t: Telemetry) -> DataFrame:
    return A.session_summaries(t.events)


@query("session_technique", "SELECT * FROM labelled")
def session_technique(t: Telemetry) -> DataFrame:
    return A.session_techniques(t.events)


@query("technique_hourly", "SELECT * FROM tech")
def technique_hourly(t: Telemetry) -> DataFrame:
    return A.technique_hourly(t.events)


def counters(t: Telemetry, span: tuple[str, str] = WEEK) -> DataFrame:
    """Counters of the trailing window; only sessions' earlier events are read beyond it."""
    return A.all_counters(t.between(*span).stored, history=t.events)


def ranks(t: Telemetry, span: tuple[str, str] = WEEK) -> DataFrame:
    return K.top_ranks(A.trailing_totals(counters(t, span), NOW))


def _technique_counters(t: Telemetry) -> DataFrame:
    return A.technique_hourly(t.events)


@query("trailing_totals", "SELECT * FROM trail")
def trailing_totals(t: Telemetry) -> DataFrame:
    return A.trailing_totals(counters(t), NOW)


@query("top_ranks", 'SELECT "window", dimension, value, count, rank FROM ranks')
def top_ranks(t: Telemetry) -> DataFrame:
    return ranks(t).withColumn("rank", F.col("rank").cast("bigint"))


@query("rank_key", """SELECT "window", dimension, rank, lpad(CAST(9999999999 - count AS VARCHAR), 10, '0') || '#' || value
  AS sort_key FROM ranks""")
def rank_key(t: Telemetry) -> DataFrame:
    return top_ranks(t).select(
        "window", "dimension", "rank", K.rank_key(F.col("count"), F.col("value")).alias("sort_key")
    )


def _flat_summary(df: DataFrame) -> DataFrame:
    labels = [F.coalesce(F.col("techniques")[x], F.lit(0).cast("bigint")).alias(x) for x in A.TECHNIQUES]
    return df.select("*", *labels).drop("techniques")


@query("daily_summary", "SELECT * FROM summaries")
def daily_summary(t: Telemetry) -> DataFrame:
    return _flat_summary(A.daily_summary(t.events, _technique_counters(t)))


@query("today_summary", "SELECT * FROM summaries WHERE day = '2024-01-30'")
def today_summary(t: Telemetry) -> DataFrame:
    """The current day. Sessions may have begun on earlier days, so the label counters see all events."""
    today = t.between("2024-01-30 00:00:00", "2024-01-31 00:00:00")
    labels = A.technique_hourly(today.events, history=t.events)
    return _flat_summary(A.daily_summary(today.events, labels, day="2024-01-30"))


@query(
    "technique_breakdown",
    """SELECT * FROM (SELECT '24h' AS span, '2024-01-30T01' AS lo UNION ALL SELECT '7d', '2024-01-24T01') w,
LATERAL (SELECT CAST(coalesce(sum(CASE WHEN value = 'brute_force' THEN count END), 0) AS BIGINT) AS brute_force,
  CAST(coalesce(sum(CASE WHEN value = 'credential_stuffing' THEN count END), 0) AS BIGINT) AS credential_stuffing,
  CAST(coalesce(sum(CASE WHEN value = 'scanner' THEN count END), 0) AS BIGINT) AS scanner,
  CAST(coalesce(sum(CASE WHEN value = 'other' THEN count END), 0) AS BIGINT) AS other
  FROM tech WHERE bucket BETWEEN w.lo AND '2024-01-31T00')""",
)
def technique_breakdown(t: Telemetry) -> DataFrame:
    tech = A.technique_hourly(t.between(*WEEK).events, history=t.events)
    both = A.technique_breakdowns(tech, NOW, {"24h": 24, "7d": 168})
    return both.withColumn("lo", F.when(F.col("span") == "24h", "2024-01-30T01").otherwise("2024-01-24T01"))


@query(
    "cohort_mix",
    """SELECT cohort, count(*) AS sessions, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM (
  SELECT session, CASE WHEN bool_or(eventid = 'cowrie.command.input') THEN 'interesting'
    WHEN bool_or(eventid = 'cowrie.login.success') THEN 'credential_stuffing'
    WHEN bool_or(eventid = 'cowrie.login.failed') AND count(DISTINCT username) = 1 THEN 'brute_force'
    WHEN bool_or(eventid = 'cowrie.login.failed') THEN 'credential_stuffing' ELSE 'scanner' END AS cohort
  FROM hp GROUP BY session) GROUP BY cohort""",
)
def cohort_mix(t: Telemetry) -> DataFrame:
    return A.cohort_mix(t.events)


@query(
    "dedup_events",
    """SELECT event_id, arrival, session, ts, eventid FROM (
  SELECT *, row_number() OVER (PARTITION BY session, ts, eventid ORDER BY arrival DESC) AS rn FROM (
    SELECT event_id, event_id AS arrival, session, ts, eventid FROM hp
    UNION ALL SELECT event_id, event_id + 1000000000, session, ts, eventid FROM hp WHERE eventid = 'cowrie.login.failed'))
WHERE rn = 1""",
)
def dedup_events(t: Telemetry) -> DataFrame:
    """Failed logins are delivered twice; the second delivery wins."""
    first = t.events.withColumn("arrival", F.col("event_id"))
    again = t.events.filter(F.col("eventid") == A.FAILED).withColumn("arrival", F.col("event_id") + 1000000000)
    return K.last_write_wins(first.unionByName(again), "arrival").select(
        "event_id", "arrival", "session", "ts", "eventid"
    )


# ---- reports

_PAGE = f"""SELECT {PUBLIC_SQL}, CAST(CASE WHEN count(*) OVER () >= 200 THEN min(ts) OVER () END AS VARCHAR) AS next_before
FROM (SELECT * FROM stored WHERE substr(ts, 1, 10) = '2024-01-30' AND (ts, session, eventid) <
  ('2024-01-30T22:00:00.000000Z', '', '') ORDER BY ts DESC, session DESC, eventid DESC LIMIT 200)"""


@query("events_page", _PAGE)
def events_page(t: Telemetry) -> DataFrame:
    day = t.between("2024-01-30 00:00:00", "2024-01-31 00:00:00")
    return R.events_page(day.stored, "2024-01-30", 200, ("2024-01-30T22:00:00.000000Z", "", ""))


@query("session_log", f"SELECT {PUBLIC_SQL} FROM stored WHERE session = 'u6-1'")
def session_log(t: Telemetry) -> DataFrame:
    return R.session_log(t.stored, "u6-1")


@query("ip_history", f"SELECT {PUBLIC_SQL} FROM stored WHERE src_ip = '45.6.6.7'")
def ip_history(t: Telemetry) -> DataFrame:
    return R.ip_history(t.stored, "45.6.6.7")


@query(
    "top_list",
    """SELECT dimension, "window", rank, value, count FROM ranks
WHERE dimension IN ('username', 'password', 'country') AND rank <= 20""",
)
def top_list(t: Telemetry) -> DataFrame:
    ranked = R.top_lists(ranks(t), 20).withColumn("rank", F.col("rank").cast("bigint"))
    return ranked.select("dimension", "window", "rank", "value", "count")


@query(
    "top_asns",
    """SELECT r.rank, CAST(value AS BIGINT) AS asn, geo.asn_org, count FROM ranks r
LEFT JOIN geo ON geo.asn = CAST(value AS BIGINT)
WHERE "window" = '7D' AND dimension = 'asn' AND rank <= 25""",
)
def top_asns(t: Telemetry) -> DataFrame:
    ranked = R.top_asns(ranks(t), "7d", 25, t.geo_ranges)
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


@query(
    "timeline_hourly",
    """SELECT strftime(b, '%Y-%m-%dT%H:00:00Z') AS ts, CAST(coalesce(c.count, 0) AS BIGINT) AS count
FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 01:00:00', TIMESTAMP '2024-01-31 00:00:00',
  INTERVAL 1 HOUR)) AS b) LEFT JOIN (SELECT bucket, sum(count) AS count FROM hourly WHERE dimension = 'eventid'
  GROUP BY bucket) c ON c.bucket = strftime(b, '%Y-%m-%dT%H')""",
)
def timeline_hourly(t: Telemetry) -> DataFrame:
    span = t.between("2024-01-01 01:00:00", "2024-01-31 01:00:00")
    per_event = A._unpivot(span.events, {"eventid": F.col("eventid")})
    return R.timeline_hourly(per_event, NOW, "30d")


@query(
    "timeline_daily",
    """SELECT strftime(b, '%Y-%m-%dT00:00:00Z') AS ts, coalesce(total_events, 0) AS count
FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-02 00:00:00', TIMESTAMP '2024-01-31 00:00:00',
  INTERVAL 1 DAY)) AS b) LEFT JOIN days ON day = strftime(b, '%Y-%m-%d')""",
)
def timeline_daily(t: Telemetry) -> DataFrame:
    span = t.between("2024-01-02 00:00:00", "2024-02-01 00:00:00")
    totals = span.events.groupBy(F.substring("ts", 1, 10).alias("day")).agg(F.count(F.lit(1)).alias("total_events"))
    return R.timeline_daily(totals, NOW, "30d")


@query(
    "summary_card",
    """SELECT 'ref' AS mode, count(*) FILTER (substr(ts, 1, 10) = '2024-01-30') AS total,
  count(*) FILTER (substr(ts, 1, 10) = '2024-01-30') AS last_24h, CAST(0 AS BIGINT) AS last_1h,
  count(DISTINCT CASE WHEN substr(ts, 1, 10) = '2024-01-30' THEN src_ip END) AS unique_ips_24h,
  max(ts) AS sensor_last_seen FROM hp
UNION ALL SELECT 'true', count(*) FILTER (substr(ts, 1, 10) = '2024-01-30'),
  count(*) FILTER (ts BETWEEN '2024-01-29T20:00:00.000000Z' AND '2024-01-30T20:00:00.000000Z'),
  count(*) FILTER (ts BETWEEN '2024-01-30T19:00:00.000000Z' AND '2024-01-30T20:00:00.000000Z'),
  count(DISTINCT CASE WHEN ts BETWEEN '2024-01-29T20:00:00.000000Z' AND '2024-01-30T20:00:00.000000Z' THEN src_ip END),
  max(ts) FROM hp""",
)
def summary_card(t: Telemetry) -> DataFrame:
    now = datetime(2024, 1, 30, 20)
    cards = [R.summary_card(t.events, now, mode).select(F.lit(mode).alias("mode"), "*") for mode in ("ref", "true")]
    return cards[0].unionByName(cards[1])


@query(
    "observed_countries",
    """SELECT count(*) AS countries FROM ranks WHERE "window" = '24H' AND dimension = 'country' AND count > 0""",
)
def observed_countries(t: Telemetry) -> DataFrame:
    return R.observed_countries(ranks(t, DAY))


@query(
    "download_report",
    """SELECT kind, value, downloads, rank, CASE WHEN kind = 'shasum'
  THEN 'https://www.virustotal.com/gui/file/' || value END AS link FROM (
  SELECT *, row_number() OVER (PARTITION BY kind ORDER BY downloads DESC, value) AS rank FROM (
    SELECT 'total' AS kind, '' AS value, count(*) AS downloads FROM hp WHERE eventid = 'cowrie.session.file_download'
    UNION ALL SELECT 'url', url, count(*) FROM hp WHERE eventid = 'cowrie.session.file_download' GROUP BY url
    UNION ALL SELECT 'shasum', shasum, count(*) FROM hp WHERE eventid = 'cowrie.session.file_download' GROUP BY shasum))
WHERE rank <= 10""",
)
def download_report(t: Telemetry) -> DataFrame:
    return R.download_report(t.events).withColumn("rank", F.col("rank").cast("bigint"))


# ---- monitoring


@query("sensor_last_seen", "SELECT sensor, max(ts) AS last_seen FROM hp GROUP BY sensor")
def sensor_last_seen(t: Telemetry) -> DataFrame:
    return G.sensor_last_seen(t.events)


@query(
    "heartbeat_gaps",
    """SELECT s.sensor, p.period_us FROM (SELECT DISTINCT sensor FROM hp) s,
(SELECT unnest(generate_series(1704067200000000, 1706659199999999, 900000000)) AS period_us) p
WHERE NOT EXISTS (SELECT 1 FROM hp WHERE hp.sensor = s.sensor AND hp.ts_us // 900000000 = p.period_us // 900000000)""",
)
def heartbeat_gaps(t: Telemetry) -> DataFrame:
    return G.heartbeat_gaps(t.events, "sensor", datetime(2024, 1, 1), NOW)


def _alarm_sql(name: str, filter_sql: str, stat: str, threshold: str, n: int, missing: str) -> str:
    return f"""SELECT '{name}' AS alarm_name, series, period_us, stat, sum(breach) OVER (PARTITION BY series
  ORDER BY period_us ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) >= {n} AS alarm
FROM (SELECT s.series, p.period_us, v.stat, CAST(coalesce(v.stat {threshold}, {missing}) AS INT) AS breach
FROM (SELECT DISTINCT sensor AS series FROM hp WHERE {filter_sql}) s
CROSS JOIN (SELECT unnest(generate_series(1704067200000000, 1706659199999999, 21600000000)) AS period_us) p
LEFT JOIN (SELECT sensor AS series, ts_us - (ts_us - 1704067200000000) % 21600000000 AS period_us, {stat} AS stat
  FROM (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY sensor, (ts_us - 1704067200000000) // 21600000000) AS tot
    FROM hp WHERE {filter_sql}
    WINDOW w AS (PARTITION BY sensor, (ts_us - 1704067200000000) // 21600000000 ORDER BY duration))
  GROUP BY ALL) v ON v.series = s.series AND v.period_us = p.period_us)"""


@query(
    "metric_alarms",
    _alarm_sql("errors", "eventid = 'cowrie.login.failed'", "CAST(count(*) AS DOUBLE)", "> 5", 1, "false")
    + " UNION ALL "
    + _alarm_sql(
        "duration_p95", "eventid = 'cowrie.session.closed'",
        "min(duration) FILTER (rn * 100 >= tot * 95)", "> 100", 2, "false")
    + " UNION ALL "
    + _alarm_sql("heartbeat", "true", "CAST(count(*) AS DOUBLE)", "< 10", 1, "true"),
)
def metric_alarms(t: Telemetry) -> DataFrame:
    span = {"period_s": 21600, "start": datetime(2024, 1, 1), "end": NOW}
    series = F.col("sensor").alias("series")
    one = F.lit(1.0).alias("value")
    failed = t.events.filter(F.col("eventid") == A.FAILED).select(series, "ts_us", one)
    closed = t.events.filter(F.col("eventid") == A.CLOSED).select(series, "ts_us", F.col("duration").alias("value"))
    every = t.events.select(series, "ts_us", one)
    alarms = {
        "errors": G.evaluate_alarm(failed, statistic="sum", threshold=5, comparison=">", periods=1, **span),
        "duration_p95": G.evaluate_alarm(closed, statistic="p95", threshold=100, comparison=">", periods=2, **span),
        "heartbeat": G.evaluate_alarm(
            every, statistic="sum", threshold=10, comparison="<", periods=1, missing="breaching", **span
        ),
    }
    parts = [df.select(F.lit(name).alias("alarm_name"), "*") for name, df in alarms.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "lateral_fanout",
    f"""SELECT src_ip, count(DISTINCT dest_ip) AS destinations, count(*) AS sessions FROM flows
WHERE regexp_matches(smb_share, '\\\\(C\\$|ADMIN\\$|IPC\\$)$') AND ts_us > {NOW_US - 7 * 86400 * 10**6} AND ts_us <= {NOW_US}
GROUP BY src_ip""",
)
def lateral_fanout(t: Telemetry) -> DataFrame:
    recent = t.between("2024-01-24 00:00:00", None)
    return G.lateral_fanout(recent.flows, NOW_US)


@query(
    "asset_inventory",
    """SELECT kind, asset, min(ts) AS first_seen, max(ts) AS last_seen FROM (
  SELECT 'host' AS kind, src_ip AS asset, ts FROM flows UNION ALL SELECT 'host', dest_ip, ts FROM flows
  UNION ALL SELECT 'service', dest_ip || ':' || dest_port, ts FROM flows
  UNION ALL SELECT 'certificate', cert_hash, ts FROM flows WHERE cert_hash IS NOT NULL) GROUP BY ALL""",
)
def asset_inventory(t: Telemetry) -> DataFrame:
    return G.asset_inventory(G.flow_sightings(t.flows))
