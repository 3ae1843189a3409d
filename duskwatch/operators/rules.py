"""Detection rules as DataFrame predicates, and the alerts they produce."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.functions.net import is_home
from duskwatch.functions.text import fill_template
from duskwatch.operators.sweep import self_counts, trailing_counts

MINUTE = 60_000_000

# Ports of the outbound rules (fixed values); the second list lacks 6666.
SUSPICIOUS_PORTS = (4444, 8888, 9001, 31337, 1337, 6666, 6667)
C2_PORTS = (4444, 8888, 9001, 31337, 1337, 6667)
ADMIN_SHARES = ("\\C$", "\\ADMIN$", "\\IPC$")
DGA_NAME = r"(?i)^[a-z0-9]{20,}\.[a-z]{2,4}$"
LARGE_TRANSFER_BYTES = 10_485_760


@dataclass(frozen=True)
class Rule:
    """A single-event rule. ``depth`` is its distance from the base rule of its family."""

    key: str
    rule_id: str
    level: int
    technique: str | None
    source: str
    depth: int
    when: Callable[[], Column]
    detail: str


def _c(name: str) -> Column:
    return F.col(name)


def _event(eventid: str) -> Callable[[], Column]:
    return lambda: _c("eventid") == eventid


def _ids_alert() -> Column:
    return _c("event_type") == "alert"


def off_hours(hour: Column) -> Column:
    """22:00 to 06:00."""
    return (hour >= 22) | (hour < 6)


def admin_share(share: Column) -> Column:
    out = F.lit(False)
    for ending in ADMIN_SHARES:
        out = out | share.endswith(ending)
    return out


def _outbound() -> Column:
    return is_home(_c("src_ip")) & ~is_home(_c("dest_ip"))


def _inbound() -> Column:
    return ~is_home(_c("src_ip")) & is_home(_c("dest_ip"))


def ssh_to_home() -> Column:
    """Connections to home hosts on the SSH port, from anywhere: what the repeated-connections rule counts."""
    return is_home(_c("dest_ip")) & (_c("dest_port") == 22)


# Source names: honeypot, ids, ioc (rows that matched an indicator), flows, dns.
RULES = (
    Rule("d1", "100100", 3, None, "honeypot", 0, lambda: _c("eventid").startswith("cowrie."), "Honeypot event"),
    Rule("d2", "100101", 5, "T1110.001", "honeypot", 1, _event("cowrie.login.failed"),
         "Failed login from $(src_ip), user $(username)"),
    Rule("d3", "100102", 10, "T1078", "honeypot", 1, _event("cowrie.login.success"),
         "Successful login from $(src_ip), user $(username)"),
    Rule("d4", "100103", 8, "T1059", "honeypot", 1, _event("cowrie.command.input"), "Command run: $(input)"),
    Rule("d5", "100104", 10, "T1105", "honeypot", 1, _event("cowrie.session.file_download"),
         "Payload download: $(url)"),
    Rule("d6", "100200", 3, None, "ids", 0, _ids_alert, "IDS alert"),
    Rule("d7", "100201", 8, "T1071", "ids", 1, lambda: _ids_alert() & (_c("severity") == 1),
         "High severity alert: $(signature)"),
    Rule("d8", "100202", 6, "T1071", "ids", 1, lambda: _ids_alert() & _c("signature").contains("ET MALWARE"),
         "Malware signature: $(signature)"),
    Rule("d9", "100203", 8, "T1595", "ids", 1, lambda: _ids_alert() & _c("signature").contains("ET SCAN"),
         "Scan signature: $(signature)"),
    Rule("d10", "100300", 12, "T1071", "ioc", 0,
         lambda: _c("indicator_event_id").isNotNull() & (_c("indicator_event_id") != ""),
         "Indicator match: $(src_ip) in event $(indicator_event_id)"),
    Rule("d11", "100301", 13, None, "ioc", 1,
         lambda: _c("indicator_event_id").isNotNull()
         & (_c("indicator_event_id") != "")
         & (_c("threat_level") == 1),
         "High threat indicator: $(info)"),
    Rule("d12", "smb_admin_share", 6, "T1021.002", "flows", 0,
         lambda: admin_share(_c("smb_share")) & off_hours(_c("ts_hour")),
         "Admin share $(smb_share) off hours by $(smb_username)"),
    Rule("d13", "unusual_outbound_port", 6, "T1571", "flows", 0,
         lambda: (_c("direction") == "outbound") & _c("dest_port").isin(*SUSPICIOUS_PORTS),
         "Outbound to port $(dest_port)"),
    Rule("d14", "1000002", 3, None, "flows", 0, lambda: _inbound() & (_c("dest_port") == 2222),
         "Honeypot port attempt from $(src_ip)"),
    Rule("d15", "1000003", 5, "T1110", "flows", 0, lambda: _inbound() & (_c("dest_port") == 23),
         "Telnet attempt from $(src_ip)"),
    Rule("d16", "1000010", 8, "T1571", "flows", 0, lambda: _outbound() & _c("dest_port").isin(*C2_PORTS),
         "Outbound to C2 port $(dest_port)"),
    Rule("d17", "1000020", 6, "T1568.002", "dns", 0, lambda: _c("dns_name").rlike(DGA_NAME),
         "Random-looking name $(dns_name)"),
    Rule("d18", "1000030", 7, "T1041", "flows", 0,
         lambda: _outbound() & (_c("bytes_sent") > LARGE_TRANSFER_BYTES),
         "Large transfer of $(bytes_sent) bytes"),
)
BY_KEY = {r.key: r for r in RULES}

# Rules over several events or joined tables: id, level, technique, source, depth. Levels of rules that name a
# severity only are a decision of this package: low 4, medium 6, high 10.
MULTI_EVENT_RULES = (
    ("100105", 10, "T1110", "honeypot", 2),
    ("100106", 12, "T1110.004", "honeypot", 2),
    ("100210", 13, "T1071", "ids", 1),
    ("1000001", 4, "T1110", "flows", 0),
    ("known_bad_ip", 10, "T1071", "ioc", 0),
)


def _alert(rule: Rule, df: DataFrame) -> Column:
    columns = {name: F.col(name) for name in df.columns}
    return F.struct(
        F.lit(rule.rule_id).alias("rule_id"),
        F.lit(rule.level).cast("bigint").alias("level"),
        F.lit(rule.technique).cast("string").alias("technique"),
        F.lit(rule.depth).cast("bigint").alias("depth"),
        fill_template(rule.detail, columns).alias("detail"),
    )


_COMMON = ("source_event", "src_ip", "ts_us")


def apply_rule(df: DataFrame, key: str) -> DataFrame:
    """Alerts of one rule over its source table."""
    rule = BY_KEY[key]
    return df.filter(rule.when()).select(*_COMMON, _alert(rule, df).alias("a")).select(*_COMMON, "a.*")


def apply_rules(df: DataFrame, source: str, *, best: bool = False) -> DataFrame:
    """Alerts of all single-event rules of a source in one pass over it; of a row only the ``best`` where that is asked.

    The best one is what ``final_alerts`` would keep of the row, so its result is the same with fewer rows to shuffle.
    """
    rules = [r for r in RULES if r.source == source]
    if best:
        rules = sorted(rules, key=lambda r: (-r.depth, -r.level, r.rule_id))
    matches = F.array_compact(F.array(*[F.when(r.when(), _alert(r, df)) for r in rules]))
    if best:
        matches = F.slice(matches, 1, 1)
    return df.select(*_COMMON, F.explode(matches).alias("a")).select(*_COMMON, "a.*")


def _multi(df: DataFrame, rule_id: str, detail: Column) -> DataFrame:
    _, level, technique, _, depth = next(r for r in MULTI_EVENT_RULES if r[0] == rule_id)
    return df.select(
        *_COMMON,
        F.lit(rule_id).alias("rule_id"),
        F.lit(level).cast("bigint").alias("level"),
        F.lit(technique).alias("technique"),
        F.lit(depth).cast("bigint").alias("depth"),
        detail.alias("detail"),
    )


def _first_only(df: DataFrame) -> DataFrame:
    """Keep the first alerting event of each source address."""
    order = Window.partitionBy("src_ip").orderBy("ts_us", "source_event")
    return df.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")


def brute_force(
    failed: DataFrame, *, threshold: int = 5, within_us: int = 5 * MINUTE, first_only: bool = False
) -> DataFrame:
    """Failed logins at which the source has at least ``threshold`` failures in the trailing interval."""
    hits = self_counts(failed, key="src_ip", hi=within_us).filter(F.col("n_events") >= threshold)
    return _first_only(hits) if first_only else hits


def credential_stuffing(
    failed: DataFrame,
    *,
    usernames: int = 10,
    failures: int = 1,
    within_us: int = 10 * MINUTE,
    first_only: bool = False,
) -> DataFrame:
    """Failed logins at which the source has tried at least ``usernames`` names in the trailing interval."""
    hits = self_counts(failed, key="src_ip", value="username", hi=within_us).filter(
        (F.col("n_distinct") >= usernames) & (F.col("n_events") >= failures)
    )
    return _first_only(hits) if first_only else hits


def threshold_both(matches: DataFrame, *, count: int = 5, seconds: int = 60) -> DataFrame:
    """One row per source and fixed interval once it has ``count`` matches."""
    width = seconds * 1_000_000
    return (
        matches.groupBy("src_ip", (F.col("ts_us") - F.pmod(F.col("ts_us"), F.lit(width))).alias("window_us"))
        .agg(F.count(F.lit(1)).alias("matches"), F.max("ts_us").alias("last_us"))
        .filter(F.col("matches") >= count)
    )


def cross_source(ids_alerts: DataFrame, failed: DataFrame, *, lookback_us: int | None = None) -> DataFrame:
    """IDS alerts whose source had a failed honeypot login before, within ``lookback_us`` if given."""
    if lookback_us is None:
        first = failed.groupBy("src_ip").agg(F.min("ts_us").alias("__first"))
        return (
            ids_alerts.join(first, "src_ip")
            .filter(F.col("__first") < F.col("ts_us"))
            .select(*ids_alerts.columns)
        )
    counted = trailing_counts(failed, ids_alerts, keys=["src_ip"], lo=1, hi=lookback_us, count_as="__n")
    return counted.filter(F.col("__n") > 0).drop("__n")


def multi_event_alerts(
    brute: DataFrame, stuffing: DataFrame, cross: DataFrame, threshold: DataFrame, bad_ip: DataFrame
) -> DataFrame:
    """The rows of the multi-event detections, and flows with a listed end (``ioc_value``), as alerts."""
    ip = F.coalesce(F.col("src_ip"), F.lit(""))
    suppressed = threshold.select(
        F.concat_ws(":", F.lit("window"), "src_ip", F.col("window_us").cast("string")).alias("source_event"),
        "src_ip",
        F.col("last_us").alias("ts_us"),
    )
    return (
        _multi(brute, "100105", F.concat(F.lit("Brute force from "), ip))
        .unionByName(_multi(stuffing, "100106", F.concat(F.lit("Credential stuffing from "), ip)))
        .unionByName(_multi(cross, "100210", F.concat(F.lit("Honeypot attacker "), ip, F.lit(" seen by the IDS"))))
        .unionByName(_multi(suppressed, "1000001", F.concat(F.lit("Repeated connections from "), ip)))
        .unionByName(_multi(bad_ip, "known_bad_ip", F.concat(F.lit("Known bad address "), F.col("ioc_value"))))
    )


def final_alerts(alerts: DataFrame) -> DataFrame:
    """One alert per source event: child rules over parents, then the highest level.

    Alerts are shuffled before they are sorted: else each task would first sort all it has made, of which there may be
    very many where a flow meets many indicators.
    """
    order = Window.partitionBy("source_event").orderBy(F.desc("depth"), F.desc("level"), F.asc("rule_id"))
    return alerts.repartition("source_event").withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")
