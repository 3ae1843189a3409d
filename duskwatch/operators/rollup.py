"""Counters, session summaries, technique labels and day summaries."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.functions.text import first_token
from duskwatch.functions.timefns import day_key, hour_key
from duskwatch.operators.joins import lookup_left

FAILED = "cowrie.login.failed"
SUCCESS = "cowrie.login.success"
COMMAND = "cowrie.command.input"
CLOSED = "cowrie.session.closed"
DOWNLOAD = "cowrie.session.file_download"
PROXY_REQUESTS = ("cowrie.direct-tcpip.request", "cowrie.direct-tcpip.data")

COUNTED_DIMENSIONS = ("username", "password", "country", "asn", "eventid")
RANKED_DIMENSIONS = ("username", "password", "country", "asn", "technique", "command", "proxy_target_port")
TECHNIQUES = ("brute_force", "credential_stuffing", "scanner", "other")
WINDOW_HOURS = {"24H": 24, "7D": 168}


def _unpivot(events: DataFrame, dimensions: dict[str, Column]) -> DataFrame:
    """(bucket, dimension, value) rows for each non-null dimension, counted."""
    pairs = F.array_compact(
        F.array(
            *[
                F.when(value.isNotNull(), F.struct(F.lit(name).alias("dimension"), value.cast("string").alias("value")))
                for name, value in dimensions.items()
            ]
        )
    )
    return (
        events.select(hour_key(F.col("ts")).alias("bucket"), F.explode(pairs).alias("p"))
        .groupBy("bucket", F.col("p.dimension").alias("dimension"), F.col("p.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
    )


def dimension_columns() -> dict[str, Column]:
    return {name: F.col(name) for name in COUNTED_DIMENSIONS}


def command_column() -> Column:
    return F.when(F.col("eventid") == COMMAND, first_token(F.col("input")))


def proxy_port_column() -> Column:
    return F.when(F.col("eventid").isin(*PROXY_REQUESTS), F.col("dst_port"))


def hourly_counts(events: DataFrame) -> DataFrame:
    """One count per hour, dimension and value of the plain event fields."""
    return _unpivot(events, dimension_columns())


def command_counts(events: DataFrame) -> DataFrame:
    return _unpivot(events, {"command": command_column()})


def proxy_port_counts(events: DataFrame) -> DataFrame:
    return _unpivot(events, {"proxy_target_port": proxy_port_column()})


def session_totals(events: DataFrame) -> DataFrame:
    """Login and command counters per session."""
    eid = F.col("eventid")
    login = eid.isin(FAILED, SUCCESS)
    return events.filter(F.col("session").isNotNull() & (F.col("session") != "")).groupBy("session").agg(
        F.count_if(eid == FAILED).alias("login_failed_count"),
        F.count_if(eid == SUCCESS).alias("login_success_count"),
        F.count_distinct(F.when(login, F.col("username"))).alias("unique_usernames"),
        F.count_if(eid == COMMAND).alias("command_count"),
        F.count(F.lit(1)).alias("event_count"),
    )


def technique_label(duration: Column, failed: Column, success: Column, usernames: Column) -> Column:
    """Technique of a closed session; the first condition that holds decides."""
    return (
        F.when((usernames >= 10) & (failed + success > 0), "credential_stuffing")
        .when((failed >= 5) & (usernames == 1), "brute_force")
        .when((duration < 2.0) & (failed + success == 0), "scanner")
        .otherwise("other")
    )


def _label() -> Column:
    return technique_label(
        F.col("duration_seconds"),
        F.col("login_failed_count"),
        F.col("login_success_count"),
        F.col("unique_usernames"),
    )


def session_summaries(events: DataFrame) -> DataFrame:
    """One row per closing of a session with the counters of the whole session."""
    closed = events.filter((F.col("eventid") == CLOSED) & F.col("session").isNotNull() & (F.col("session") != "")).select(
        "session", "ts", F.coalesce(F.col("duration"), F.lit(0.0)).alias("duration_seconds")
    )
    totals = session_totals(events)
    return lookup_left(closed, totals, "session", spread_by=["ts"], rows_per_key="event_count")


def session_techniques(events: DataFrame) -> DataFrame:
    return session_summaries(events).withColumn("technique", _label())


def technique_hourly(events: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Technique counter at the hour of the closing.

    ``history`` holds the sessions' earlier events when ``events`` is only a time slice.
    Closings are counted per (session, hour, short or not) before they meet the session
    totals, so a session with many closings is a few rows in the join.
    """
    closed = (
        events.filter((F.col("eventid") == CLOSED) & F.col("session").isNotNull() & (F.col("session") != ""))
        .groupBy(
            "session",
            hour_key(F.col("ts")).alias("bucket"),
            F.when(F.coalesce(F.col("duration"), F.lit(0.0)) < 2.0, 0.0).otherwise(2.0).alias("duration_seconds"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        closed.join(session_totals(events if history is None else history), "session")
        .groupBy("bucket", F.lit("technique").alias("dimension"), _label().alias("value"))
        .agg(F.sum("n").alias("count"))
    )


def all_counters(events: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Every counter the rankings use: plain fields, command, proxy port and technique."""
    plain = _unpivot(
        events,
        dimension_columns() | {"command": command_column(), "proxy_target_port": proxy_port_column()},
    )
    return plain.unionByName(technique_hourly(events, history))


def hour_bounds(now: datetime, hours: int) -> tuple[str, str]:
    """First and last hour bucket of the trailing window that ends with the current hour."""
    top = now.replace(minute=0, second=0, microsecond=0)
    return (top - timedelta(hours=hours - 1)).strftime("%Y-%m-%dT%H"), top.strftime("%Y-%m-%dT%H")


def trailing_totals(counters: DataFrame, now: datetime) -> DataFrame:
    """Sums over the current and the previous 23 or 167 hour buckets, both windows in one pass."""
    flags = []
    first, last = "9", ""
    for name, hours in WINDOW_HOURS.items():
        lo, hi = hour_bounds(now, hours)
        first, last = min(first, lo), max(last, hi)
        flags.append(F.when(F.col("bucket").between(lo, hi), F.lit(name)))
    return (
        counters.filter(F.col("bucket").between(first, last) & F.col("value").isNotNull())
        .withColumn("window", F.explode(F.array_compact(F.array(*flags))))
        .groupBy("window", "dimension", "value")
        .agg(F.sum("count").alias("count"))
    )


def daily_summary(events: DataFrame, techniques: DataFrame, *, day: str | None = None) -> DataFrame:
    """Day totals with the technique map; ``techniques`` is the hourly technique counter.

    Distinct counts run through an aggregate per (day, value) first, so a day with a third
    of the rows is still spread.
    """
    src, tech = events, techniques
    if day is not None:
        src = src.filter(day_key(F.col("ts")) == day)
        tech = tech.filter(F.substring("bucket", 1, 10) == day)
    eid = F.col("eventid")
    base = src.groupBy(day_key(F.col("ts")).alias("day")).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_distinct(F.when(F.col("src_ip") != "", F.col("src_ip"))).alias("unique_ips"),
        F.count_distinct(F.when(F.col("session") != "", F.col("session"))).alias("unique_sessions"),
        F.count_if(eid == SUCCESS).alias("successful_logins"),
        F.count_if(eid == DOWNLOAD).alias("file_downloads"),
    )
    labels = (
        tech.groupBy(F.substring("bucket", 1, 10).alias("day"), "value")
        .agg(F.sum("count").alias("n"))
        .groupBy("day")
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "n")))).alias("techniques"))
    )
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    joined = base.join(labels, "day", "left")
    if day is not None:
        # An empty day still has a row of zeros.
        joined = joined.sparkSession.createDataFrame([(day,)], "day string").join(joined, "day", "left")
    counts = ("total_events", "unique_ips", "unique_sessions", "successful_logins", "file_downloads")
    return joined.select(
        "day",
        *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in counts],
        F.coalesce("techniques", empty).alias("techniques"),
    )


def technique_breakdowns(techniques: DataFrame, now: datetime, spans: dict[str, int]) -> DataFrame:
    """Totals of the four labels over trailing windows, given in hours by name; one aggregate for all, absent labels are 0."""
    sums = []
    for span, hours in spans.items():
        lo, hi = hour_bounds(now, hours)
        inside = F.col("bucket").between(lo, hi)
        labels = [F.coalesce(F.sum(F.when(inside & (F.col("value") == t), F.col("count"))), F.lit(0)).alias(t) for t in TECHNIQUES]
        sums.append(F.struct(F.lit(span).alias("span"), *labels))
    return techniques.agg(F.array(*sums).alias("s")).select(F.inline("s"))


def technique_breakdown(techniques: DataFrame, now: datetime, hours: int = 24) -> DataFrame:
    """Totals of the four labels over one trailing window."""
    return technique_breakdowns(techniques, now, {"": hours}).drop("span")


def cohort_mix(events: DataFrame) -> DataFrame:
    """Share of session shapes."""
    eid = F.col("eventid")
    shapes = (
        events.groupBy("session")
        .agg(
            F.max(eid == COMMAND).alias("has_command"),
            F.max(eid == SUCCESS).alias("has_success"),
            F.max(eid == FAILED).alias("has_failed"),
            F.count_distinct("username").alias("usernames"),
        )
        .select(
            F.when(F.col("has_command"), "interesting")
            .when(F.col("has_success"), "credential_stuffing")
            .when(F.col("has_failed") & (F.col("usernames") == 1), "brute_force")
            .when(F.col("has_failed"), "credential_stuffing")
            .otherwise("scanner")
            .alias("cohort")
        )
        .groupBy("cohort")
        .agg(F.count(F.lit(1)).alias("sessions"))
    )
    # At most four rows are left here, so a window over all of them is safe.
    total = F.sum("sessions").over(Window.partitionBy(F.lit(0)))
    return shapes.select("cohort", "sessions", F.round(F.col("sessions") / total, 6).alias("share"))
