"""SQL twins of the telemetry views, in dependency order."""

from __future__ import annotations

from duskwatch.operators.triage import TECHNIQUE_CATALOGUE
from duskwatch.sources.telemetry import COUNTRIES, FLOW_PORTS, INPUTS, RELAY_PORTS, SHARES, SIGNATURES

# Written out, so that a wrong pattern of the operators shows.
IPV4_SQL = r"^((25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$"


def sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def ip_long(c: str) -> str:
    parts = " + ".join(f"CAST(split_part({c}, '.', {i + 1}) AS BIGINT) * {256 ** (3 - i)}" for i in range(4))
    return f"CASE WHEN regexp_matches({c}, '{IPV4_SQL}') THEN {parts} END"


def is_home(c: str) -> str:
    v = f"({ip_long(c)})"
    return (
        f"coalesce({v} BETWEEN 167772160 AND 184549375 OR {v} BETWEEN 2886729728 AND 2887778303 "
        f"OR {v} BETWEEN 3232235520 AND 3232301055, false)"
    )


def _ip(n: str) -> str:
    return f"'45.' || ({n} % 27) || '.' || ({n} % 250) || '.7'"


HOME = "'10.0.' || (user_id % 20) || '.' || (1 + k)"

VIEWS: dict[str, str] = {}

VIEWS["base"] = """
SELECT event_id, user_id, event_type, value, epoch_us(ts) AS ts_us,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts, day(ts) AS dom
FROM events"""

VIEWS["hp0"] = f"""
SELECT *,
  CASE event_type WHEN 'error' THEN 'cowrie.login.failed' WHEN 'signup' THEN 'cowrie.login.success'
    WHEN 'purchase' THEN 'cowrie.session.closed' WHEN 'view' THEN 'cowrie.session.connect'
    ELSE CASE k % 10 WHEN 0 THEN 'cowrie.direct-tcpip.request' WHEN 1 THEN 'cowrie.direct-tcpip.data'
      WHEN 2 THEN 'cowrie.session.file_download' ELSE 'cowrie.command.input' END END AS eventid,
  {_ip("user_id")} AS src_ip
FROM base"""

VIEWS["hp1"] = """
SELECT *, CASE WHEN eventid = 'cowrie.session.file_download'
  THEN 'http://' || src_ip || '/p' || (k // 10) || '.sh' END AS url FROM hp0"""

VIEWS["hp"] = f"""
SELECT event_id, user_id, k, event_type, ts_us, ts, eventid,
  CASE WHEN user_id % 10 = 9 THEN 'e' || event_id ELSE 'u' || user_id || '-' || ((dom - 1) // 15) END AS session,
  src_ip, 'sensor-' || (user_id % 4) AS sensor,
  CASE WHEN user_id % 2 = 0 THEN 'ssh' ELSE 'telnet' END AS protocol,
  CASE WHEN event_type = 'view' THEN 1024 + event_id % 60000 END AS src_port,
  CAST(CASE WHEN eventid LIKE 'cowrie.direct-tcpip.%' THEN {sql_list(RELAY_PORTS)}[CAST(1 + (k // 10) % 5 AS BIGINT)]
    WHEN event_type = 'view' THEN 2222 END AS BIGINT) AS dst_port,
  CASE WHEN event_type IN ('error', 'signup') THEN
    CASE WHEN user_id % 3 = 0 THEN 'root' ELSE 'user' || (k % 40) END END AS username,
  CASE WHEN event_type IN ('error', 'signup') THEN 'Brand#' || (1 + k % 6) || (1 + user_id % 6) END AS password,
  CASE WHEN eventid = 'cowrie.command.input' THEN {sql_list(INPUTS)}[CAST(1 + k % 8 AS BIGINT)] END AS input,
  url, md5(url) AS shasum,
  CASE WHEN event_type = 'purchase' THEN value END AS duration
FROM hp1"""

VIEWS["wire"] = """
SELECT event_id, k,
  CASE WHEN k = 90 THEN 'ssh.login' ELSE eventid END AS eventid,
  CASE WHEN k = 91 THEN substr(ts, 1, 26) || '+00:00' ELSE ts END AS timestamp,
  CASE WHEN k = 92 THEN '300.1.2.3' ELSE src_ip END AS src_ip,
  CASE WHEN k = 93 THEN '' WHEN k = 99 THEN repeat('s', 65) ELSE session END AS session,
  CASE WHEN k = 94 THEN '' ELSE sensor END AS sensor,
  CASE WHEN k = 95 THEN 'ftp' ELSE protocol END AS protocol,
  CASE WHEN k = 96 THEN '70000' WHEN k <> 98 THEN CAST(src_port AS VARCHAR) END AS src_port,
  CASE WHEN k <> 98 THEN CAST(dst_port AS VARCHAR) END AS dst_port,
  CASE WHEN k <> 98 THEN username END AS username,
  password,
  CASE WHEN k <> 98 THEN input END AS input,
  CASE WHEN k <> 98 THEN url END AS url,
  shasum,
  CASE WHEN k = 97 THEN '-1' WHEN k <> 98 THEN CAST(duration AS VARCHAR) END AS duration
FROM hp"""

VIEWS["tun"] = """
SELECT * REPLACE (CASE WHEN user_id % 2 = 0 AND event_type <> 'view' THEN '127.0.0.1' ELSE src_ip END AS src_ip)
FROM hp"""

VIEWS["px"] = """
SELECT event_id, ts_us, replace(ts, 'Z', '+00:00') AS ts, src_ip AS client_ip, src_port AS client_port,
  CAST(22 AS BIGINT) AS frontend_port, k AS duration, k * 10 AS bytes_uploaded, k * 20 AS bytes_downloaded,
  'cD' AS status, user_id % 2 = 1 AS late
FROM hp WHERE event_type = 'view'"""

VIEWS["geo"] = f"""
SELECT CAST(45 * 16777216 + n_nationkey * 65536 AS BIGINT) AS lo,
  CAST(45 * 16777216 + n_nationkey * 65536 + 65535 AS BIGINT) AS hi,
  {sql_list(COUNTRIES)}[CAST(1 + n_nationkey % {len(COUNTRIES)} AS BIGINT)] AS country,
  CAST(n_nationkey AS BIGINT) AS asn, n_name AS asn_org
FROM nation"""

VIEWS["dict"] = "SELECT DISTINCT p_brand AS word FROM part"

VIEWS["stored"] = f"""
SELECT hp.* EXCLUDE (password), country, asn, asn_org,
  CASE WHEN password IS NOT NULL AND word IS NULL THEN '<filtered:len=' || length(password) || '>'
    ELSE password END AS password,
  CASE WHEN word IS NULL THEN password END AS password_raw
FROM hp LEFT JOIN geo ON {ip_long("src_ip")} BETWEEN lo AND hi LEFT JOIN dict ON password = word"""

VIEWS["ids"] = f"""
SELECT event_id, 'ids:' || event_id AS source_event, ts_us, ts,
  CASE WHEN k % 10 = 9 THEN 'dns' ELSE 'alert' END AS event_type, src_ip, {HOME} AS dest_ip,
  1 + k % 3 AS severity, {sql_list(SIGNATURES)}[CAST(1 + k % 4 AS BIGINT)] AS signature
FROM hp WHERE event_type = 'view'"""

VIEWS["flows"] = f"""
SELECT *, CASE WHEN dest_port = 443 THEN md5(dest_ip) END AS cert_hash FROM (
SELECT event_id AS flow_id, 'flow:' || event_id AS source_event, ts_us, ts,
  CAST(substr(ts, 12, 2) AS BIGINT) AS ts_hour,
  CASE WHEN event_id % 2 = 0 THEN 'outbound' ELSE 'inbound' END AS direction,
  CASE WHEN event_id % 2 = 0 THEN {HOME} ELSE {_ip("user_id")} END AS src_ip,
  CASE WHEN event_id % 2 = 0 THEN {_ip("user_id")} ELSE {HOME} END AS dest_ip,
  CAST({sql_list(FLOW_PORTS)}[CAST(1 + k % {len(FLOW_PORTS)} AS BIGINT)] AS BIGINT) AS dest_port,
  CAST(round(value * 500000) AS BIGINT) AS bytes_sent,
  chr(92) || chr(92) || 'srv' || (user_id % 8) || chr(92) || {sql_list(SHARES)}[CAST(1 + k % 4 AS BIGINT)] AS smb_share,
  'svc' || (k % 7) AS smb_username
FROM base WHERE event_type IN ('view', 'purchase'))"""

VIEWS["ind"] = f"""
SELECT 'ip' AS kind, {_ip("s_suppkey")} AS value, 'm' || s_suppkey AS indicator_event_id,
  CAST(1 + s_nationkey % 4 AS BIGINT) AS threat_level, s_name AS info, 'feed' || (s_suppkey % 3) AS feed
FROM supplier"""

VIEWS["dns"] = """
SELECT 'dns:' || page_id AS source_event, '10.0.0.' || (page_id % 250) AS src_ip,
  1704067200000000 + page_id * 1000000 AS ts_us,
  CASE WHEN page_id % 5 = 0 THEN substr(md5(url), 1, 24) || '.com'
    ELSE regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1) END AS dns_name
FROM pages"""

VIEWS["lab"] = "SELECT 'hp:' || doc_id AS source_event, quality = 1 AS true_positive FROM labels"

VIEWS["honey"] = "SELECT *, 'hp:' || event_id AS source_event FROM hp"

VIEWS["failed"] = """
SELECT source_event, src_ip, ts_us, username FROM honey WHERE eventid = 'cowrie.login.failed'"""

# Counters.
VIEWS["pairs"] = r"""
SELECT substr(ts, 1, 13) AS bucket, 'username' AS dimension, username AS value FROM stored
UNION ALL SELECT substr(ts, 1, 13), 'password', password FROM stored
UNION ALL SELECT substr(ts, 1, 13), 'country', country FROM stored
UNION ALL SELECT substr(ts, 1, 13), 'asn', CAST(asn AS VARCHAR) FROM stored
UNION ALL SELECT substr(ts, 1, 13), 'eventid', eventid FROM stored"""

VIEWS["hourly"] = """
SELECT bucket, dimension, value, count(*) AS count FROM pairs WHERE value IS NOT NULL GROUP BY ALL"""

VIEWS["commands"] = r"""
SELECT substr(ts, 1, 13) AS bucket, 'command' AS dimension, regexp_extract(input, '^\s*(\S+)', 1) AS value,
  count(*) AS count
FROM hp WHERE eventid = 'cowrie.command.input' AND regexp_extract(input, '^\s*(\S+)', 1) <> '' GROUP BY ALL"""

VIEWS["relays"] = """
SELECT substr(ts, 1, 13) AS bucket, 'proxy_target_port' AS dimension, CAST(dst_port AS VARCHAR) AS value,
  count(*) AS count
FROM hp WHERE eventid IN ('cowrie.direct-tcpip.request', 'cowrie.direct-tcpip.data') AND dst_port IS NOT NULL
GROUP BY ALL"""

VIEWS["totals"] = """
SELECT session, count(*) FILTER (eventid = 'cowrie.login.failed') AS login_failed_count,
  count(*) FILTER (eventid = 'cowrie.login.success') AS login_success_count,
  count(DISTINCT CASE WHEN eventid IN ('cowrie.login.failed', 'cowrie.login.success') THEN username END)
    AS unique_usernames,
  count(*) FILTER (eventid = 'cowrie.command.input') AS command_count
FROM hp WHERE session <> '' GROUP BY session"""

VIEWS["closings"] = """
SELECT hp.session, ts, coalesce(duration, 0.0) AS duration_seconds, login_failed_count, login_success_count,
  unique_usernames, command_count
FROM hp JOIN totals ON hp.session = totals.session WHERE eventid = 'cowrie.session.closed'"""

VIEWS["labelled"] = """
SELECT *, CASE WHEN unique_usernames >= 10 AND login_failed_count + login_success_count > 0 THEN 'credential_stuffing'
  WHEN login_failed_count >= 5 AND unique_usernames = 1 THEN 'brute_force'
  WHEN duration_seconds < 2.0 AND login_failed_count + login_success_count = 0 THEN 'scanner'
  ELSE 'other' END AS technique FROM closings"""

VIEWS["tech"] = """
SELECT substr(ts, 1, 13) AS bucket, 'technique' AS dimension, technique AS value, count(*) AS count
FROM labelled GROUP BY ALL"""

VIEWS["counters"] = """
SELECT * FROM hourly UNION ALL SELECT * FROM commands UNION ALL SELECT * FROM relays UNION ALL SELECT * FROM tech"""

VIEWS["windows"] = """
SELECT * FROM (VALUES ('24H', '2024-01-30T01'), ('7D', '2024-01-24T01')) AS w(win, lo)"""

VIEWS["trail"] = """
SELECT win AS "window", dimension, value, CAST(sum(count) AS BIGINT) AS count
FROM counters JOIN windows ON bucket BETWEEN lo AND '2024-01-31T00' GROUP BY ALL"""

VIEWS["ranks"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "window", dimension ORDER BY count DESC, value) AS rank
  FROM trail WHERE dimension <> 'eventid') WHERE rank <= 25"""

VIEWS["days"] = """
SELECT substr(ts, 1, 10) AS day, count(*) AS total_events, count(DISTINCT src_ip) AS unique_ips,
  count(DISTINCT session) AS unique_sessions, count(*) FILTER (eventid = 'cowrie.login.success') AS successful_logins,
  count(*) FILTER (eventid = 'cowrie.session.file_download') AS file_downloads
FROM hp GROUP BY ALL"""

VIEWS["daylabels"] = """
SELECT substr(bucket, 1, 10) AS day,
  CAST(sum(CASE WHEN value = 'brute_force' THEN count ELSE 0 END) AS BIGINT) AS brute_force,
  CAST(sum(CASE WHEN value = 'credential_stuffing' THEN count ELSE 0 END) AS BIGINT) AS credential_stuffing,
  CAST(sum(CASE WHEN value = 'scanner' THEN count ELSE 0 END) AS BIGINT) AS scanner,
  CAST(sum(CASE WHEN value = 'other' THEN count ELSE 0 END) AS BIGINT) AS other
FROM tech GROUP BY ALL"""

VIEWS["summaries"] = """
SELECT days.*, coalesce(brute_force, 0) AS brute_force, coalesce(credential_stuffing, 0) AS credential_stuffing,
  coalesce(scanner, 0) AS scanner, coalesce(other, 0) AS other
FROM days LEFT JOIN daylabels ON days.day = daylabels.day"""


# Correlation: 10 minutes with a floor of 1 second.
def _forward(proxies: str) -> str:
    return f"""
SELECT e.event_id, e.session, e.ts, e.ts_us, e.eventid, e.src_ip AS sensor_ip, count(p.ts_us) AS n,
  min(p.client_ip) AS ip, string_agg(p.client_ip, ',' ORDER BY p.ts_us, p.client_ip) AS ips
FROM tun e LEFT JOIN {proxies} p ON e.src_ip = '127.0.0.1' AND p.ts_us BETWEEN e.ts_us - 600000000 AND e.ts_us - 1000000
GROUP BY ALL"""


_STATUS = """
SELECT *, CASE WHEN sensor_ip <> '127.0.0.1' THEN NULL WHEN n = 0 THEN 'missed' WHEN n = 1 THEN 'matched'
    ELSE 'ambiguous' END AS status,
  CASE WHEN sensor_ip = '127.0.0.1' AND n = 1 THEN ip ELSE sensor_ip END AS src_ip FROM {0}"""

VIEWS["fwd0"] = _forward("px")
VIEWS["fwd"] = _STATUS.format("fwd0")
VIEWS["early"] = "SELECT * FROM px WHERE NOT late"
VIEWS["latepx"] = "SELECT * FROM px WHERE late"
VIEWS["efwd0"] = _forward("early")
VIEWS["efwd"] = _STATUS.format("efwd0")


def _inherit(source: str) -> str:
    return f"""
SELECT f.* EXCLUDE (status, src_ip, n, ips),
  CASE WHEN later THEN 'matched_inherited' ELSE status END AS status,
  CASE WHEN later THEN m_ip ELSE src_ip END AS src_ip,
  CASE WHEN later THEN 1 ELSE n END AS n,
  CASE WHEN later THEN m_ip ELSE ips END AS ips
FROM (SELECT f.*, m.m_ip, coalesce(f.status IS NOT NULL AND (f.ts_us, f.eventid) > (m.m_ts, m.m_eid), false) AS later
  FROM {source} f LEFT JOIN (
    SELECT session, ts_us AS m_ts, eventid AS m_eid, src_ip AS m_ip FROM (
      SELECT *, row_number() OVER (PARTITION BY session ORDER BY ts_us, eventid, src_ip) AS rn
      FROM {source} WHERE status = 'matched') WHERE rn = 1) m ON f.session = m.session) f"""


VIEWS["inh"] = _inherit("fwd")
VIEWS["einh"] = _inherit("efwd")
VIEWS["targets"] = """
SELECT p.ts_us, p.client_ip, count(DISTINCT e.session) AS owners, min(e.session) AS session
FROM latepx p LEFT JOIN einh e ON e.src_ip = '127.0.0.1' AND e.ts_us BETWEEN p.ts_us + 1000000 AND p.ts_us + 600000000
GROUP BY ALL"""
VIEWS["bwd"] = """
SELECT e.* EXCLUDE (status, src_ip, n, ips),
  CASE WHEN hit THEN 'matched' ELSE status END AS status,
  CASE WHEN hit THEN w_ip ELSE src_ip END AS src_ip,
  CASE WHEN hit THEN 1 ELSE n END AS n
FROM (SELECT e.*, w.w_ip,
    w.w_ip IS NOT NULL AND (e.status IS NULL OR e.status IN ('missed', 'ambiguous')) AS hit
  FROM einh e LEFT JOIN (SELECT session AS w_session, client_ip AS w_ip FROM (
      SELECT *, row_number() OVER (PARTITION BY session ORDER BY ts_us, client_ip) AS rn FROM targets WHERE owners = 1)
    WHERE rn = 1) w ON e.session = w.w_session) e"""

VIEWS["nearest"] = """
SELECT e.event_id, e.ts_us, (SELECT max(p.ts_us) FROM px p WHERE p.ts_us <= e.ts_us - 1000000) AS point_us
FROM tun e WHERE e.src_ip = '127.0.0.1'"""

# Rules.
VIEWS["ioc"] = """
SELECT f.*, i.* EXCLUDE (kind, value), 'src' AS matched_on FROM flows f JOIN ind i ON f.src_ip = i.value
UNION ALL SELECT f.*, i.* EXCLUDE (kind, value), 'dest' FROM flows f JOIN ind i ON f.dest_ip = i.value
WHERE f.dest_ip <> f.src_ip"""
VIEWS["iocev"] = """
SELECT * REPLACE ('ioc:' || flow_id || ':' || indicator_event_id AS source_event) FROM ioc"""

_OUT = f"{is_home('src_ip')} AND NOT {is_home('dest_ip')}"
_IN = f"NOT {is_home('src_ip')} AND {is_home('dest_ip')}"
_SHARE = "(" + " OR ".join(f"ends_with(smb_share, chr(92) || '{s}')" for s in ("C$", "ADMIN$", "IPC$")) + ")"
_IOC = "indicator_event_id IS NOT NULL AND indicator_event_id <> ''"

# Condition and message of each single-event rule.
RULE_SQL = {
    "d1": ("starts_with(eventid, 'cowrie.')", "'Honeypot event'"),
    "d2": ("eventid = 'cowrie.login.failed'",
           "'Failed login from ' || coalesce(src_ip, '') || ', user ' || coalesce(username, '')"),
    "d3": ("eventid = 'cowrie.login.success'",
           "'Successful login from ' || coalesce(src_ip, '') || ', user ' || coalesce(username, '')"),
    "d4": ("eventid = 'cowrie.command.input'", "'Command run: ' || coalesce(input, '')"),
    "d5": ("eventid = 'cowrie.session.file_download'", "'Payload download: ' || coalesce(url, '')"),
    "d6": ("event_type = 'alert'", "'IDS alert'"),
    "d7": ("event_type = 'alert' AND severity = 1", "'High severity alert: ' || signature"),
    "d8": ("event_type = 'alert' AND contains(signature, 'ET MALWARE')", "'Malware signature: ' || signature"),
    "d9": ("event_type = 'alert' AND contains(signature, 'ET SCAN')", "'Scan signature: ' || signature"),
    "d10": (_IOC, "'Indicator match: ' || src_ip || ' in event ' || indicator_event_id"),
    "d11": (f"{_IOC} AND threat_level = 1", "'High threat indicator: ' || info"),
    "d12": (f"{_SHARE} AND (ts_hour >= 22 OR ts_hour < 6)",
            "'Admin share ' || smb_share || ' off hours by ' || smb_username"),
    "d13": ("direction = 'outbound' AND dest_port IN (4444, 8888, 9001, 31337, 1337, 6666, 6667)",
            "'Outbound to port ' || dest_port"),
    "d14": (f"{_IN} AND dest_port = 2222", "'Honeypot port attempt from ' || src_ip"),
    "d15": (f"{_IN} AND dest_port = 23", "'Telnet attempt from ' || src_ip"),
    "d16": (f"{_OUT} AND dest_port IN (4444, 8888, 9001, 31337, 1337, 6667)", "'Outbound to C2 port ' || dest_port"),
    "d17": ("regexp_matches(dns_name, '(?i)^[a-z0-9]{20,}\\.[a-z]{2,4}$')", "'Random-looking name ' || dns_name"),
    "d18": (f"{_OUT} AND bytes_sent > 10485760", "'Large transfer of ' || bytes_sent || ' bytes'"),
}
_SOURCE = {"honeypot": "honey", "ids": "ids", "ioc": "iocev", "flows": "flows", "dns": "dns"}


def _text(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"


# Fixed values, written out again so that a wrong constant of an operator shows: id, level, technique, depth, source.
RULE_FACTS = {
    "d1": ("100100", 3, None, 0, "honeypot"),
    "d2": ("100101", 5, "T1110.001", 1, "honeypot"),
    "d3": ("100102", 10, "T1078", 1, "honeypot"),
    "d4": ("100103", 8, "T1059", 1, "honeypot"),
    "d5": ("100104", 10, "T1105", 1, "honeypot"),
    "d6": ("100200", 3, None, 0, "ids"),
    "d7": ("100201", 8, "T1071", 1, "ids"),
    "d8": ("100202", 6, "T1071", 1, "ids"),
    "d9": ("100203", 8, "T1595", 1, "ids"),
    "d10": ("100300", 12, "T1071", 0, "ioc"),
    "d11": ("100301", 13, None, 1, "ioc"),
    "d12": ("smb_admin_share", 6, "T1021.002", 0, "flows"),
    "d13": ("unusual_outbound_port", 6, "T1571", 0, "flows"),
    "d14": ("1000002", 3, None, 0, "flows"),
    "d15": ("1000003", 5, "T1110", 0, "flows"),
    "d16": ("1000010", 8, "T1571", 0, "flows"),
    "d17": ("1000020", 6, "T1568.002", 0, "dns"),
    "d18": ("1000030", 7, "T1041", 0, "flows"),
}
MULTI_FACTS = {
    "100105": (10, "T1110", 2),
    "100106": (12, "T1110.004", 2),
    "100210": (13, "T1071", 1),
    "1000001": (4, "T1110", 0),
    "known_bad_ip": (10, "T1071", 0),
}


def rule_sql(key: str) -> str:
    rule_id, level, technique, depth, source = RULE_FACTS[key]
    cond, detail = RULE_SQL[key]
    return (
        f"SELECT source_event, src_ip, CAST(ts_us AS BIGINT) AS ts_us, '{rule_id}' AS rule_id, "
        f"CAST({level} AS BIGINT) AS level, {_text(technique)} AS technique, "
        f"CAST({depth} AS BIGINT) AS depth, {detail} AS detail FROM {_SOURCE[source]} WHERE {cond}"
    )


def _multi_sql(view: str, rule_id: str, detail: str, source_event: str = "source_event", ts: str = "ts_us") -> str:
    level, technique, depth = MULTI_FACTS[rule_id]
    return (
        f"SELECT {source_event} AS source_event, src_ip, {ts} AS ts_us, '{rule_id}' AS rule_id, "
        f"CAST({level} AS BIGINT) AS level, '{technique}' AS technique, CAST({depth} AS BIGINT) AS depth, "
        f"{detail} AS detail FROM {view}"
    )


# The sample events are sparse, so intervals are a day and thresholds are low.
VIEWS["rolling"] = """
SELECT *, count(*) OVER w AS n_events, count(DISTINCT username) OVER w AS n_distinct FROM failed
WINDOW w AS (PARTITION BY src_ip ORDER BY ts_us RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW)"""
VIEWS["brute"] = "SELECT source_event, src_ip, ts_us, username, n_events FROM rolling WHERE n_events >= 3"
VIEWS["stuffing"] = """
SELECT source_event, src_ip, ts_us, username, n_events, n_distinct FROM rolling WHERE n_distinct >= 3"""
VIEWS["threshold"] = """
SELECT src_ip, ts_us - ts_us % 604800000000 AS window_us, count(*) AS matches, max(ts_us) AS last_us
FROM flows WHERE dest_port = 22 AND (starts_with(dest_ip, '10.') OR starts_with(dest_ip, '192.168.')
  OR regexp_matches(dest_ip, '^172\\.(1[6-9]|2[0-9]|3[01])\\.')) GROUP BY ALL HAVING count(*) >= 2"""
VIEWS["crossed"] = """
SELECT * FROM ids i WHERE event_type = 'alert' AND EXISTS (SELECT 1 FROM failed f WHERE f.src_ip = i.src_ip
  AND f.ts_us BETWEEN i.ts_us - 86400000000 AND i.ts_us - 1)"""
VIEWS["alerts"] = "\nUNION ALL ".join(
    [rule_sql(key) for key in RULE_FACTS]
    + [
        _multi_sql("brute", "100105", "'Brute force from ' || src_ip"),
        _multi_sql("stuffing", "100106", "'Credential stuffing from ' || src_ip"),
        _multi_sql("crossed", "100210", "'Honeypot attacker ' || src_ip || ' seen by the IDS'"),
        _multi_sql("threshold", "1000001", "'Repeated connections from ' || src_ip",
                   "'window:' || src_ip || ':' || window_us", "last_us"),
        _multi_sql("iocev", "known_bad_ip", "'Known bad address ' || CASE matched_on WHEN 'src' THEN src_ip ELSE dest_ip END"),
    ]
)
VIEWS["catalogue"] = (
    "SELECT * FROM (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in TECHNIQUE_CATALOGUE) + ") AS c(tactic, technique)"
)
_RULE_ROWS = [(f[0], f[2]) for f in RULE_FACTS.values()] + [(i, f[1]) for i, f in MULTI_FACTS.items()]
VIEWS["ruletable"] = (
    "SELECT * FROM (VALUES " + ", ".join(f"('{i}', {_text(t)})" for i, t in _RULE_ROWS) + ") AS r(rule_id, technique)"
)
