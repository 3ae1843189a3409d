"""Monitoring, alert statistics and triage reports."""

from __future__ import annotations

from calendar import timegm
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.operators.rules import admin_share
from duskwatch.operators.quantiles import nearest_ranks

# ATT&CK techniques tracked for coverage (fixed values): tactic, technique.
TECHNIQUE_CATALOGUE = (
    ("Initial Access", "T1110"),
    ("Initial Access", "T1110.001"),
    ("Initial Access", "T1110.004"),
    ("Initial Access", "T1078"),
    ("Lateral Movement", "T1021.002"),
    ("Lateral Movement", "T1021.001"),
    ("Command & Control", "T1071"),
    ("Command & Control", "T1571"),
    ("Reconnaissance", "T1595"),
    ("Persistence", "T1543"),
    ("Persistence", "T1547.001"),
    ("Defense Evasion", "T1070"),
    ("Defense Evasion", "T1027"),
)


def to_us(moment: datetime) -> int:
    return timegm(moment.utctimetuple()) * 1_000_000 + moment.microsecond


def sensor_last_seen(events: DataFrame) -> DataFrame:
    return events.groupBy("sensor").agg(F.max("ts").alias("last_seen"))


def _spine(keys: DataFrame, key: str, start_us: int, end_us: int, width_us: int) -> DataFrame:
    """Every period start in ``[start, end)`` for every key."""
    return keys.select(
        key, F.explode(F.sequence(F.lit(start_us), F.lit(end_us - 1), F.lit(width_us))).alias("period_us")
    )


def heartbeat_gaps(
    records: DataFrame, source: str, start: datetime, end: datetime, *, minutes: int = 15
) -> DataFrame:
    """Periods in which a source delivered nothing. Missing data is a breach."""
    width = minutes * 60_000_000
    lo, hi = to_us(start), to_us(end)
    period = F.lit(lo) + (F.col("ts_us") - lo) - F.pmod(F.col("ts_us") - lo, F.lit(width))
    seen = (
        records.filter((F.col("ts_us") >= lo) & (F.col("ts_us") < hi)).select(source, period.alias("period_us")).distinct()
    )
    return _spine(records.select(source).distinct(), source, lo, hi, width).join(
        seen, [source, "period_us"], "left_anti"
    )


def evaluate_alarm(
    metric: DataFrame,
    *,
    statistic: str,
    threshold: float,
    comparison: str,
    periods: int,
    period_s: int,
    start: datetime,
    end: datetime,
    missing: str = "notBreaching",
) -> DataFrame:
    """State per series and period: in alarm when the last ``periods`` periods all breach.

    ``metric`` has ``series, ts_us, value``. The p95 is the nearest-rank value, taken from
    value counts of one bin, so a busy period is not put in order in one task.
    """
    width = period_s * 1_000_000
    lo, hi = to_us(start), to_us(end)
    period = F.col("ts_us") - F.pmod(F.col("ts_us") - lo, F.lit(width))
    inside = metric.filter((F.col("ts_us") >= lo) & (F.col("ts_us") < hi)).withColumn("period_us", period)
    keys = ["series", "period_us"]
    if statistic == "sum":
        stats = inside.groupBy(*keys).agg(F.sum("value").cast("double").alias("stat"))
    elif statistic == "max":
        stats = inside.groupBy(*keys).agg(F.max("value").cast("double").alias("stat"))
    elif statistic == "p95":
        stats = nearest_ranks(inside, keys, "value", [95]).select(*keys, F.col("value").cast("double").alias("stat"))
    else:
        raise ValueError(f"unknown statistic {statistic!r}")
    if comparison not in (">", "<"):
        raise ValueError(f"unknown comparison {comparison!r}")
    if missing not in ("breaching", "notBreaching"):
        raise ValueError(f"unknown missing-data policy {missing!r}")
    over = F.col("stat") > threshold if comparison == ">" else F.col("stat") < threshold
    spine = _spine(metric.select("series").distinct(), "series", lo, hi, width)
    recent = Window.partitionBy("series").orderBy("period_us").rowsBetween(-(periods - 1), 0)
    return (
        spine.join(stats, keys, "left")
        .withColumn("breach", F.coalesce(over, F.lit(missing == "breaching")).cast("int"))
        .withColumn("breaches", F.sum("breach").over(recent))
        .select("series", "period_us", "stat", (F.col("breaches") >= periods).alias("alarm"))
    )


def rule_stats(alerts: DataFrame, labels: DataFrame) -> DataFrame:
    """Fires, true and false positives and verdict per rule.

    ``labels`` has one row per ``source_event`` with ``true_positive``. A rule is STABLE at
    a true-positive rate of 70 % or more of its labelled alerts, else it is up for REVIEW.
    """
    joined = alerts.join(labels, "source_event", "left")
    return (
        joined.groupBy("rule_id")
        .agg(
            F.count(F.lit(1)).alias("fires"),
            F.count_if(F.col("true_positive")).alias("true_positives"),
            F.count_if(~F.col("true_positive")).alias("false_positives"),
        )
        .withColumn(
            "tp_rate",
            F.round(
                F.try_divide(F.col("true_positives"), F.col("true_positives") + F.col("false_positives")), 6
            ),
        )
        .withColumn("verdict", F.when(F.coalesce(F.col("tp_rate") >= 0.7, F.lit(False)), "STABLE").otherwise("REVIEW"))
    )


def attacker_triage(
    events: DataFrame, indicators: DataFrame, stuffing: DataFrame, cross: DataFrame
) -> DataFrame:
    """Flags per attacker address; any flag escalates."""
    attackers = (
        events.filter(F.col("eventid").isin("cowrie.login.failed", "cowrie.login.success"))
        .groupBy("src_ip")
        .agg(
            F.count_if(F.col("eventid") == "cowrie.login.failed").alias("failed_logins"),
            F.bool_or(F.col("eventid") == "cowrie.login.success").alias("logged_in"),
        )
    )
    listed = indicators.select(F.col("value").alias("src_ip")).distinct().withColumn("known_bad", F.lit(True))
    stuffed = stuffing.select("src_ip").distinct().withColumn("stuffing", F.lit(True))
    crossed = cross.select("src_ip").distinct().withColumn("cross_source", F.lit(True))
    joined = attackers.join(listed, "src_ip", "left").join(stuffed, "src_ip", "left").join(crossed, "src_ip", "left")
    flag = {c: F.coalesce(F.col(c), F.lit(False)) for c in ("known_bad", "stuffing", "logged_in", "cross_source")}
    escalate = flag["known_bad"] | flag["stuffing"] | flag["logged_in"] | flag["cross_source"]
    return joined.select("src_ip", "failed_logins", *[v.alias(k) for k, v in flag.items()], escalate.alias("escalate"))


def lateral_fanout(flows: DataFrame, now_us: int, *, days: int = 7) -> DataFrame:
    """Distinct destinations each source reached over admin shares in the trailing days."""
    lo = now_us - days * 86_400_000_000
    return (
        flows.filter(admin_share(F.col("smb_share")) & (F.col("ts_us") > lo) & (F.col("ts_us") <= now_us))
        .groupBy("src_ip")
        .agg(F.count_distinct("dest_ip").alias("destinations"), F.count(F.lit(1)).alias("sessions"))
    )


def asset_inventory(sightings: DataFrame) -> DataFrame:
    """First and last sighting per asset; ``sightings`` has ``kind, asset, ts``."""
    return sightings.groupBy("kind", "asset").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))


def flow_sightings(flows: DataFrame) -> DataFrame:
    """Hosts, services and certificates seen in flows."""
    seen = F.array_compact(
        F.array(
            F.struct(F.lit("host").alias("kind"), F.col("src_ip").alias("asset")),
            F.struct(F.lit("host").alias("kind"), F.col("dest_ip").alias("asset")),
            F.struct(
                F.lit("service").alias("kind"),
                F.concat_ws(":", "dest_ip", F.col("dest_port").cast("string")).alias("asset"),
            ),
            F.when(
                F.col("cert_hash").isNotNull(),
                F.struct(F.lit("certificate").alias("kind"), F.col("cert_hash").alias("asset")),
            ),
        )
    )
    return flows.select("ts", F.explode(seen).alias("s")).select("s.kind", "s.asset", "ts")


def technique_coverage(catalogue: DataFrame, rules: DataFrame) -> DataFrame:
    """Each technique, whether a rule covers it, and the coverage tier of its tactic."""
    ruled = rules.filter(F.col("technique").isNotNull()).select("technique", F.lit(True).alias("__hit")).distinct()
    marked = catalogue.join(ruled, "technique", "left").withColumn("covered", F.col("__hit").isNotNull())
    tiers = marked.groupBy("tactic").agg(F.bool_and("covered").alias("__all"), F.bool_or("covered").alias("__any"))
    tier = F.when(F.col("__all"), "covered").when(~F.col("__any"), "none").otherwise("partial")
    return marked.join(tiers.select("tactic", tier.alias("coverage")), "tactic").select("tactic", "technique", "covered", "coverage")


def coverage_gaps(catalogue: DataFrame, rules: DataFrame) -> DataFrame:
    """Techniques no rule covers, with the coverage tier of their tactic."""
    return technique_coverage(catalogue, rules).filter(~F.col("covered")).select("tactic", "technique", "coverage")


def latency_distribution(latencies: DataFrame, *, quantiles: tuple[float, ...] = (0.5, 0.95)) -> DataFrame:
    """Count, extremes and nearest-rank quantiles of ``delta_us`` at millisecond steps.

    Quantiles come from counts per bin and then per millisecond of one bin, so no task gets them all.
    """
    ms = latencies.filter(F.col("delta_us").isNotNull()).select(F.floor(F.col("delta_us") / 1000).cast("bigint").alias("ms"))
    ends = ms.agg(F.count(F.lit(1)).alias("measured"), F.min("ms").alias("min_ms"), F.max("ms").alias("max_ms"))
    names = {round(q * 100): f"p{round(q * 100)}_ms" for q in quantiles}
    cuts = nearest_ranks(ms, [], "ms", list(names)).agg(*[F.max(F.when(F.col("percent") == p, F.col("value"))).alias(n) for p, n in names.items()])
    columns = ["measured", "min_ms", *names.values(), "max_ms"]
    return ends.unionByName(cuts, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in columns])


def window_sweep(latencies: DataFrame, widths_us: tuple[int, ...]) -> DataFrame:
    """Share of events with a proxy row within each candidate window."""
    counted = latencies.agg(
        F.count(F.lit(1)).alias("events"),
        *[F.count_if(F.col("delta_us") <= w).alias(f"w{w}") for w in widths_us],
    )
    rows = F.array(
        *[F.struct(F.lit(w).cast("bigint").alias("width_us"), F.col(f"w{w}").alias("hits")) for w in widths_us]
    )
    return counted.select("events", F.explode(rows).alias("r")).select(
        "r.width_us", "events", "r.hits", F.round(F.try_divide("r.hits", "events"), 6).alias("hit_rate")
    )
