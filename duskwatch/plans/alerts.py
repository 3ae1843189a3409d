"""Queries on detection rules, alerts and triage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.operators import rules as D
from duskwatch.operators import triage as G
from duskwatch.plans.counts import ioc
from duskwatch.plans.registry import query
from duskwatch.plans.views import rule_sql
from duskwatch.sources.telemetry import Telemetry

DAY_US = 86_400_000_000
WEEK_S = 604_800


def ioc_events(t: Telemetry) -> DataFrame:
    return ioc(t).withColumn(
        "source_event", F.concat_ws(":", F.lit("ioc"), F.col("flow_id").cast("string"), "indicator_event_id")
    )


def _source(t: Telemetry, name: str) -> DataFrame:
    if name == "ioc":
        return ioc_events(t)
    return {"honeypot": t.honeypot, "ids": t.ids, "flows": t.flows, "dns": t.dns}[name]


def _register_rule(key: str, source: str) -> None:
    @query(f"rule_{key}", rule_sql(key))
    def run(t: Telemetry) -> DataFrame:
        return D.apply_rule(_source(t, source), key)


for _rule in D.RULES:
    _register_rule(_rule.key, _rule.source)


# The sample events are sparse: three failures or names within a day, two SSH connections within a week.
def brute(t: Telemetry) -> DataFrame:
    return D.brute_force(t.failed, threshold=3, within_us=DAY_US)


def stuffing(t: Telemetry) -> DataFrame:
    return D.credential_stuffing(t.failed, usernames=3, within_us=DAY_US)


def crossed(t: Telemetry) -> DataFrame:
    return D.cross_source(t.ids.filter(F.col("event_type") == "alert"), t.failed, lookback_us=DAY_US)


def threshold(t: Telemetry) -> DataFrame:
    return D.threshold_both(t.flows.filter(D.ssh_to_home()), count=2, seconds=WEEK_S)


@query("alert_bruteforce", "SELECT * FROM brute")
def alert_bruteforce(t: Telemetry) -> DataFrame:
    return brute(t)


@query("alert_stuffing", "SELECT * FROM stuffing")
def alert_stuffing(t: Telemetry) -> DataFrame:
    return stuffing(t)


@query(
    "alert_stuffing_variant",
    "SELECT source_event, src_ip, ts_us, username, n_events, n_distinct FROM rolling WHERE n_distinct >= 2 AND n_events >= 3",
)
def alert_stuffing_variant(t: Telemetry) -> DataFrame:
    """Failures and names both over a limit."""
    return D.credential_stuffing(t.failed, usernames=2, failures=3, within_us=DAY_US)


@query(
    "alert_first_only",
    """SELECT source_event, src_ip, ts_us, username, n_events FROM (SELECT *,
  row_number() OVER (PARTITION BY src_ip ORDER BY ts_us, source_event) AS rn FROM brute) WHERE rn = 1""",
)
def alert_first_only(t: Telemetry) -> DataFrame:
    return D.brute_force(t.failed, threshold=3, within_us=DAY_US, first_only=True)


@query("alert_threshold", "SELECT * FROM threshold")
def alert_threshold(t: Telemetry) -> DataFrame:
    return threshold(t)


@query("cross_source", "SELECT source_event, src_ip, ts_us, severity, signature FROM crossed")
def cross_source(t: Telemetry) -> DataFrame:
    return crossed(t).select("source_event", "src_ip", "ts_us", "severity", "signature")


@query(
    "cross_source_ever",
    """SELECT source_event, src_ip, ts_us FROM ids i WHERE event_type = 'alert'
AND EXISTS (SELECT 1 FROM failed f WHERE f.src_ip = i.src_ip AND f.ts_us < i.ts_us)""",
)
def cross_source_ever(t: Telemetry) -> DataFrame:
    return D.cross_source(t.ids.filter(F.col("event_type") == "alert"), t.failed).select(
        "source_event", "src_ip", "ts_us"
    )


def all_alerts(t: Telemetry, *, best: bool = False) -> DataFrame:
    """Alerts of every rule, each source read once for its single-event rules (``best``: see ``apply_rules``)."""
    out = D.multi_event_alerts(brute(t), stuffing(t), crossed(t), threshold(t), ioc_events(t))
    for name in ("honeypot", "ids", "ioc", "flows", "dns"):
        out = out.unionByName(D.apply_rules(_source(t, name), name, best=best))
    return out


@query("alerts_all", "SELECT * FROM alerts")
def alerts_all(t: Telemetry) -> DataFrame:
    return all_alerts(t)


@query(
    "alerts_final",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY source_event
  ORDER BY depth DESC, level DESC, rule_id) AS rn FROM alerts) WHERE rn = 1""",
)
def alerts_final(t: Telemetry) -> DataFrame:
    return D.final_alerts(all_alerts(t, best=True))


@query(
    "rule_stats",
    """SELECT rule_id, fires, true_positives, false_positives, tp_rate,
  CASE WHEN coalesce(tp_rate >= 0.7, false) THEN 'STABLE' ELSE 'REVIEW' END AS verdict FROM (
  SELECT rule_id, fires, true_positives, false_positives, CASE WHEN true_positives + false_positives > 0
    THEN round(true_positives / (true_positives + false_positives), 6) END AS tp_rate FROM (
    SELECT rule_id, count(*) AS fires, count(*) FILTER (true_positive) AS true_positives,
      count(*) FILTER (NOT true_positive) AS false_positives
    FROM alerts LEFT JOIN lab ON alerts.source_event = lab.source_event GROUP BY rule_id))""",
)
def rule_stats(t: Telemetry) -> DataFrame:
    return G.rule_stats(all_alerts(t), t.labels)


@query(
    "attacker_triage",
    """SELECT *, known_bad OR stuffing OR logged_in OR cross_source AS escalate FROM (
  SELECT src_ip, count(*) FILTER (eventid = 'cowrie.login.failed') AS failed_logins,
    src_ip IN (SELECT value FROM ind) AS known_bad, src_ip IN (SELECT src_ip FROM stuffing) AS stuffing,
    bool_or(eventid = 'cowrie.login.success') AS logged_in, src_ip IN (SELECT src_ip FROM crossed) AS cross_source
  FROM hp WHERE eventid IN ('cowrie.login.failed', 'cowrie.login.success') GROUP BY src_ip)""",
)
def attacker_triage(t: Telemetry) -> DataFrame:
    return G.attacker_triage(t.events, t.indicators, stuffing(t), crossed(t))
