"""Recovery of the real client address of tunnelled events.

Tunnelled events carry the loopback address. The proxy logged the real client shortly
before, so a time window over the proxy log finds it (forward), later events of a session
take the address of its first match (inherit), and proxy rows that arrive late are matched
to stored events (backward).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.functions.net import LOOPBACK
from duskwatch.operators.enrich import geo_enrich
from duskwatch.operators.joins import interval_join, lookup_left
from duskwatch.operators.sweep import nearest_preceding, single_owner, trailing_counts
from duskwatch.session import stage

WINDOW_US = 500_000
FLOOR_US = 1_000


def candidate_counts(
    events: DataFrame, proxies: DataFrame, *, window_us: int = WINDOW_US, floor_us: int = FLOOR_US
) -> DataFrame:
    """Per distinct instant of a tunnelled event: number of proxy rows in its window, and the newest client."""
    instants = events.filter(F.col("src_ip") == LOOPBACK).select("ts_us").distinct()
    if window_us <= floor_us:
        return instants.select("ts_us", F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("string").alias("ip"))
    return trailing_counts(
        proxies.select("ts_us", "client_ip"), instants, lo=floor_us, hi=window_us, carry="client_ip", count_as="n"
    ).withColumnRenamed("last_client_ip", "ip")


def _ambiguous_pairs(counts: DataFrame, proxies: DataFrame, window_us: int, floor_us: int) -> DataFrame:
    return interval_join(
        counts.filter(F.col("n") > 1).select(F.col("ts_us").alias("__at")),
        proxies.select(F.col("ts_us").alias("__p"), "client_ip"),
        left_time="__at",
        right_time="__p",
        lo=floor_us,
        hi=window_us,
    )


def candidates_of(
    events: DataFrame, proxies: DataFrame, *, window_us: int = WINDOW_US, floor_us: int = FLOOR_US
) -> DataFrame:
    """One row per ambiguous instant and candidate: ``ts_us, proxy_us, client_ip``."""
    counts = candidate_counts(events, proxies, window_us=window_us, floor_us=floor_us)
    return _ambiguous_pairs(counts, proxies, window_us, floor_us).select(
        F.col("__at").alias("ts_us"), F.col("__p").alias("proxy_us"), "client_ip"
    )


def candidate_spans(
    events: DataFrame, proxies: DataFrame, *, window_us: int = WINDOW_US, floor_us: int = FLOOR_US
) -> DataFrame:
    """Candidate list of each ambiguous instant as ``ts_us, n, oldest_us, newest_us``.

    The candidates are exactly the proxy rows between the two times, so this says all the
    list says in one row, however many candidates there are.
    """
    counts = candidate_counts(events, proxies, window_us=window_us, floor_us=floor_us)
    several = stage(counts.filter(F.col("n") > 1).select("ts_us", "n"), "ambiguous")
    newest = nearest_preceding(several, proxies, floor_us=floor_us).withColumnRenamed("point_us", "newest_us")
    # The oldest one is the nearest preceding one with time running backwards.
    back = nearest_preceding(
        several.select("ts_us", (F.lit(window_us) - F.col("ts_us")).alias("__back")),
        proxies.select((-F.col("ts_us")).alias("__back")),
        time="__back",
    ).select(F.col("ts_us").alias("__at"), (-F.col("point_us")).alias("oldest_us"))
    return newest.join(back, newest["ts_us"] == back["__at"]).select("ts_us", "n", "oldest_us", "newest_us")


def correlate_forward(
    events: DataFrame,
    proxies: DataFrame,
    *,
    window_us: int = WINDOW_US,
    floor_us: int = FLOOR_US,
    list_candidates: bool = False,
) -> DataFrame:
    """Add ``correlation_status, correlation_candidate_count`` (and ``correlation_candidate_ips``).

    Status, count and address need no pairs. Listing the candidates of ambiguous events does
    by its nature, so it is off unless asked for; ``candidate_spans`` says as much in one row
    an event.
    """
    counts = candidate_counts(events, proxies, window_us=window_us, floor_us=floor_us)
    if list_candidates:
        listed = (
            _ambiguous_pairs(counts, proxies, window_us, floor_us)
            .groupBy("__at")
            .agg(F.array_sort(F.collect_list(F.struct("__p", "client_ip"))).alias("__pairs"))
            .select("__at", F.col("__pairs.client_ip").alias("__ips"))
        )
        counts = counts.join(listed, counts["ts_us"] == listed["__at"], "left").drop("__at")
    tunnelled = F.col("src_ip") == LOOPBACK
    joined = lookup_left(
        events.withColumn("__instant", F.when(tunnelled, F.col("ts_us"))),
        counts.withColumnsRenamed({"ts_us": "__instant", "n": "__n", "ip": "__ip"}),
        "__instant",
        spread_by=["session", "ts"],
    )
    one = F.col("__n") == 1
    out = (
        joined.withColumn(
            "correlation_status",
            F.when(tunnelled, F.when(one, "matched").when(F.col("__n") > 1, "ambiguous").otherwise("missed")),
        )
        .withColumn("correlation_candidate_count", F.when(tunnelled, F.col("__n")))
    )
    if list_candidates:
        empty = F.array().cast("array<string>")
        out = out.withColumn(
            "correlation_candidate_ips",
            F.when(
                tunnelled,
                F.when(one, F.array("__ip")).when(F.col("__n") > 1, F.col("__ips")).otherwise(empty),
            ),
        )
    out = out.withColumn("src_ip", F.when(F.coalesce(one, F.lit(False)), F.col("__ip")).otherwise(F.col("src_ip")))
    return out.drop("__instant", "__n", "__ip", "__ips")


def inherit_matches(events: DataFrame, *, hot_rows: int | None = None) -> DataFrame:
    """Tunnelled events after the first match of their session (by ts, eventid) take its address."""
    hot = {} if hot_rows is None else {"hot_rows": hot_rows}
    matched = F.col("correlation_status") == "matched"
    first = (
        events.groupBy("session")
        .agg(
            F.count(F.lit(1)).alias("__rows"),
            F.min(F.when(matched, F.struct("ts_us", "eventid", "src_ip"))).alias("__first"),
        )
        .filter(F.col("__first").isNotNull())
    )
    joined = lookup_left(
        events, first, "session", spread_by=["ts", "eventid"], rows_per_key="__rows", **hot
    )
    later = (
        F.col("correlation_status").isNotNull()
        & F.col("__first").isNotNull()
        & (F.struct("ts_us", "eventid") > F.struct(F.col("__first.ts_us"), F.col("__first.eventid")))
    )
    return _take_address(joined, F.coalesce(later, F.lit(False)), F.col("__first.src_ip"), "matched_inherited").drop(
        "__first", "__hit"
    )


def backward_targets(
    events: DataFrame, proxies: DataFrame, *, window_us: int = WINDOW_US, floor_us: int = FLOOR_US
) -> DataFrame:
    """Per distinct proxy instant: ``owners`` (0, 1, 2 = several) and the session when there is just one."""
    waiting = events.filter(F.col("src_ip") == LOOPBACK).select("ts_us", "session")
    return single_owner(waiting, proxies, owner="session", lo=floor_us, hi=window_us)


def correlate_backward(
    events: DataFrame,
    proxies: DataFrame,
    *,
    window_us: int = WINDOW_US,
    floor_us: int = FLOOR_US,
    geo_ranges: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Match stored events to newly arrived proxy rows; matched events are never overwritten.

    All proxy rows see the state before the batch, and the earliest one wins a session.
    With ``geo_ranges`` the changed events are looked up again; only non-null results replace.
    """
    hot = {} if hot_rows is None else {"hot_rows": hot_rows}
    targets = backward_targets(events, proxies, window_us=window_us, floor_us=floor_us).filter("owners = 1")
    clients = proxies.groupBy("ts_us").agg(F.min("client_ip").alias("client_ip"))
    winners = (
        targets.join(clients, "ts_us")
        .groupBy("session")
        .agg(F.min(F.struct("ts_us", "client_ip")).alias("__win"))
        .select("session", F.col("__win.client_ip").alias("__ip"))
    )
    if geo_ranges is not None:
        found = geo_enrich(winners.withColumnRenamed("__ip", "src_ip"), geo_ranges)
        winners = found.select(
            "session",
            F.col("src_ip").alias("__ip"),
            F.struct("country", "asn", "asn_org").alias("__geo"),
        )
    sizes = events.groupBy("session").agg(F.count(F.lit(1)).alias("__rows"))
    joined = lookup_left(
        events, winners.join(sizes, "session"), "session", spread_by=["ts", "eventid"], rows_per_key="__rows", **hot
    )
    open_status = F.col("correlation_status").isNull() | F.col("correlation_status").isin("missed", "ambiguous")
    hit = F.col("__ip").isNotNull() & open_status
    out = _take_address(joined, hit, F.col("__ip"), "matched")
    if geo_ranges is not None:
        for c in ("country", "asn", "asn_org"):
            out = out.withColumn(c, F.coalesce(F.when(F.col("__hit"), F.col(f"__geo.{c}")), F.col(c)))
    return out.drop("__ip", "__geo", "__hit")


def _take_address(df: DataFrame, when, ip, status: str) -> DataFrame:
    """Set the address and correlation columns of the rows for which ``when`` holds."""
    out = (
        df.withColumn("__hit", when)
        .withColumn("src_ip", F.when(F.col("__hit"), ip).otherwise(F.col("src_ip")))
        .withColumn("correlation_status", F.when(F.col("__hit"), status).otherwise(F.col("correlation_status")))
        .withColumn(
            "correlation_candidate_count",
            F.when(F.col("__hit"), F.lit(1).cast("bigint")).otherwise(F.col("correlation_candidate_count")),
        )
    )
    if "correlation_candidate_ips" in df.columns:
        out = out.withColumn(
            "correlation_candidate_ips",
            F.when(F.col("__hit"), F.array(F.col("src_ip"))).otherwise(F.col("correlation_candidate_ips")),
        )
    return out


def resolve(
    events: DataFrame,
    early_proxies: DataFrame,
    late_proxies: DataFrame,
    geo_ranges: DataFrame,
    *,
    window_us: int = WINDOW_US,
    floor_us: int = FLOOR_US,
    list_candidates: bool = False,
) -> DataFrame:
    """Forward, inherit, backward, geo. Each later pass reads its input several times, so it is staged."""
    span = {"window_us": window_us, "floor_us": floor_us}
    forward = stage(correlate_forward(events, early_proxies, list_candidates=list_candidates, **span), "forward")
    inherited = stage(inherit_matches(forward), "inherited")
    return geo_enrich(correlate_backward(inherited, late_proxies, **span), geo_ranges)


def correlation_outcomes(
    forward: DataFrame,
    inherited: DataFrame,
    late_proxies: DataFrame,
    *,
    window_us: int = WINDOW_US,
    floor_us: int = FLOOR_US,
) -> DataFrame:
    """Counts by metric and label: the candidate histogram and the outcomes of each pass.

    ``matched_new`` / ``matched_skipped_already_matched`` count proxy rows whose one session
    still had, or no longer had, an event to update.
    """
    histogram = (
        forward.filter(F.col("correlation_candidate_count").isNotNull())
        .groupBy(F.col("correlation_candidate_count").cast("string").alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit("candidate_count").alias("metric"), "label", "n")
    )
    status = (
        inherited.filter(F.col("correlation_status").isNotNull())
        .groupBy(F.col("correlation_status").alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit("event_status").alias("metric"), "label", "n")
    )
    targets = backward_targets(inherited, late_proxies, window_us=window_us, floor_us=floor_us)
    rows = late_proxies.groupBy("ts_us").agg(F.count(F.lit(1)).alias("rows"))
    open_sessions = (
        inherited.filter(F.col("correlation_status").isNull() | F.col("correlation_status").isin("missed", "ambiguous"))
        .select("session")
        .distinct()
        .withColumn("__open", F.lit(True))
    )
    outcome = (
        lookup_left(targets.join(rows, "ts_us"), open_sessions, "session", spread_by=["ts_us"])
        .groupBy(
            F.when(F.col("owners") == 0, "no_candidates")
            .when(F.col("owners") > 1, "ambiguous")
            .when(F.col("__open"), "matched_new")
            .otherwise("matched_skipped_already_matched")
            .alias("label")
        )
        .agg(F.sum("rows").alias("n"))
        .select(F.lit("backward_outcome").alias("metric"), "label", "n")
    )
    return histogram.unionByName(status).unionByName(outcome)


def ambiguous_share(forward: DataFrame, limits: tuple[float, float] = (0.05, 0.10)) -> DataFrame:
    """Share of ambiguous events among tunnelled ones, against the watch and the alarm limit."""
    return (
        forward.filter(F.col("correlation_status").isNotNull())
        .agg(
            F.count(F.lit(1)).alias("tunnelled"),
            F.count_if(F.col("correlation_status") == "ambiguous").alias("ambiguous"),
        )
        .withColumn("share", F.round(F.col("ambiguous") / F.col("tunnelled"), 6))
        .withColumn("over_watch", F.col("share") > limits[0])
        .withColumn("over_limit", F.col("share") > limits[1])
    )
