"""Keyed state: session labels, address inheritance, rolling alerts.

Rows of a key come in Arrow batches of no fixed order. Session counters are sums, so order is no matter; the
others keep rows until the watermark has passed them. State is dropped by event-time timers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

FAILED, SUCCESS = "cowrie.login.failed", "cowrie.login.success"
COMMAND, CLOSED = "cowrie.command.input", "cowrie.session.closed"


def texts_of(column: pd.Series) -> list[str | None]:
    return [None if pd.isna(v) else v for v in column]


class _Expiring(StatefulProcessor):
    """Clears its state ``keep_ms`` after the newest row of the key. The timer is kept in the state row."""

    keep_ms = 3_600_000
    fields = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", f"timer long{self.fields}")

    def renewed(self, timer: int | None, newest_us: int) -> int:
        """Move the timer when the key has newer rows; returns the one in force."""
        at = newest_us // 1000 + self.keep_ms
        if timer is not None and timer >= at:
            return timer
        if timer is not None:
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(at)
        return at

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.clear()
        return iter(())

    def clear(self) -> None:
        self.state.clear()

    def close(self) -> None:
        pass


class SessionCounters(_Expiring):
    """Counters per session; a summary row for each closing, with what has arrived so far."""

    fields = ", failed long, succeeded long, commands long, usernames long"

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.names = handle.getMapState("names", "name string", "seen boolean")

    def clear(self) -> None:
        super().clear()
        self.names.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        timer, failed, succeeded, commands, usernames = self.state.get() or (None, 0, 0, 0, 0)
        known = usernames > 0
        closings, newest, fresh = [], 0, set()
        for pdf in rows:
            kind = pdf["eventid"].to_numpy()
            failed += int((kind == FAILED).sum())
            succeeded += int((kind == SUCCESS).sum())
            commands += int((kind == COMMAND).sum())
            login = (kind == FAILED) | (kind == SUCCESS)
            for name in set(pdf.loc[login, "username"].dropna()) - fresh:
                fresh.add(name)
                if not (known and self.names.containsKey((name,))):
                    self.names.updateValue((name,), (True,))
                    usernames += 1
            closed = kind == CLOSED
            if closed.any():
                closings.append(pdf.loc[closed, ["ts", "duration"]])
            newest = max(newest, int(pdf["ts_us"].max()))
        self.state.update((self.renewed(timer, newest), failed, succeeded, commands, usernames))
        for closed in closings:
            yield pd.DataFrame(
                {
                    "session": key[0],
                    "ts": closed["ts"],
                    "duration_seconds": closed["duration"].fillna(0.0),
                    "login_failed_count": failed,
                    "login_success_count": succeeded,
                    "unique_usernames": usernames,
                    "command_count": commands,
                }
            )


def session_summary_stream(events: DataFrame, *, watermark: str = "1 hour", keep_ms: int = 86_400_000) -> DataFrame:
    """Session summaries as sessions close. Needs ``session, ts, ts_us, event_time, eventid, username, duration``.

    A closing gets what has arrived so far and is not older than ``keep_ms``; ``counters.maintain_session_summaries``
    gives whole sessions.
    """
    return (
        events.select("session", "ts", "ts_us", "event_time", "eventid", "username", "duration")
        .filter((F.col("session").isNotNull()) & (F.col("session") != ""))
        .withWatermark("event_time", watermark)
        .groupBy("session")
        .transformWithStateInPandas(
            statefulProcessor=SessionCounters(keep_ms),
            outputStructType=(
                "session string, ts string, duration_seconds double, login_failed_count long, "
                "login_success_count long, unique_usernames long, command_count long"
            ),
            outputMode="append",
            timeMode="EventTime",
        )
    )


class FirstMatch(StatefulProcessor):
    """Remembers the first matched address of a session and gives it to later events.

    Rows wait until the watermark passes them and are then taken in the order of (ts_us, eventid), so how they were cut
    into batches has no effect. The state goes ``keep_ms`` after the newest row of the session.
    """

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "timer long, newest long, ip string")
        self.waiting = handle.getListState("waiting", "ts_us long, eventid string, event_id long, src_ip string, status string")

    def moved(self, timer: int | None, at: int) -> int:
        if timer is not None and timer != at:
            self.handle.deleteTimer(timer)
        if timer != at:
            self.handle.registerTimer(at)
        return at

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        timer, newest, ip = self.state.get() or (None, 0, None)
        first = None
        for pdf in rows:
            times = pdf["ts_us"].astype("int64")
            newest, first = max(newest, int(times.max())), min(first or int(times.min()), int(times.min()))
            texts = [texts_of(pdf[c]) for c in ("eventid", "src_ip", "status")]
            ids = [None if pd.isna(i) else int(i) for i in pdf["event_id"]]
            self.waiting.appendList(list(zip(times.tolist(), texts[0], ids, *texts[1:])))
        if first is not None:
            due = first // 1000 + 1
            if timer is None or due < timer or timer >= newest // 1000 + self.keep_ms - 1:
                timer = self.moved(timer, due)
            self.state.update((timer, newest, ip))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        _, newest, ip = self.state.get() or (None, 0, None)
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        plain = ((int(r[0]), r[1], None if pd.isna(r[2]) else int(r[2]), *r[3:]) for r in self.waiting.get())
        rows = sorted(plain, key=lambda r: (r[0], r[1] or "", -1 if r[2] is None else r[2]))
        due, later = [r for r in rows if r[0] <= passed], [r for r in rows if r[0] > passed]
        if not rows:
            self.state.clear()
            return
        self.waiting.put(later) if later else self.waiting.clear()
        out = []
        for _, _, event_id, src_ip, status in due:
            if ip is not None and status is not None:
                out.append((event_id, key[0], ip, "matched_inherited"))
            else:
                out.append((event_id, key[0], src_ip, status))
                if status == "matched":
                    ip = src_ip
        at = later[0][0] // 1000 + 1 if later else newest // 1000 + self.keep_ms
        self.handle.registerTimer(at)
        self.state.update((at, newest, ip))
        if out:
            ids, sessions, ips, statuses = zip(*out)
            yield pd.DataFrame({"event_id": pd.array(ids, "Int64"), "session": sessions, "src_ip": ips, "status": statuses})

    def close(self) -> None:
        pass


def inherit_stream(events: DataFrame, *, watermark: str = "1 hour", keep_ms: int = 86_400_000) -> DataFrame:
    """Inheritance in event order. Needs ``event_id, session, ts_us, event_time, eventid, src_ip, status``."""
    return (
        events.select("event_id", "session", "ts_us", "event_time", "eventid", "src_ip", "status")
        .withWatermark("event_time", watermark)
        .groupBy("session")
        .transformWithStateInPandas(
            statefulProcessor=FirstMatch(keep_ms),
            outputStructType="event_id long, session string, src_ip string, status string",
            outputMode="append",
            timeMode="EventTime",
        )
    )


def trailing_window_counts(times: np.ndarray, names: list, width_us: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row of a time-sorted log: rows and distinct names in ``[t - width, t]``, rows at t included."""
    last = np.searchsorted(times, times, side="right")
    first = np.searchsorted(times, times - width_us, side="left")
    distinct = np.zeros(len(times), dtype=np.int64)
    inside: Counter = Counter()
    lo = hi = 0
    for i in range(len(times)):
        while hi < last[i]:
            inside[names[hi]] += 1
            hi += 1
        while lo < first[i]:
            inside[names[lo]] -= 1
            if not inside[names[lo]]:
                del inside[names[lo]]
            lo += 1
        distinct[i] = len(inside) - (None in inside)
    return last - first, distinct


class RollingCounts(StatefulProcessor):
    """Failures and distinct names of a source over a trailing interval, a chunk of one interval's length at a time.

    A key is a source and a chunk; rows of the chunk before come along as context. All wait for the watermark to pass
    the chunk and are then counted in order, so cuts into batches have no effect, and a hot source is as many tasks as
    it has chunks.
    """

    def __init__(self, width_us: int):
        self.width_us = width_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.timed = handle.getValueState("timed", "at long")
        self.log = handle.getListState("log", "ts_us long, source_event string, username string, own boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            columns = [texts_of(pdf[c]) for c in ("source_event", "username")]
            self.log.appendList(list(zip(pdf["ts_us"].astype("int64").tolist(), *columns, pdf["own"].astype(bool).tolist())))
        if not self.timed.exists():
            at = (int(key[1]) + 1) * self.width_us // 1000
            self.handle.registerTimer(at)
            self.timed.update((at,))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows = sorted(self.log.get(), key=lambda r: (r[0], r[1] or ""))
        self.log.clear()
        self.timed.clear()
        times = np.array([r[0] for r in rows], dtype=np.int64)
        counts, distinct = trailing_window_counts(times, [r[2] for r in rows], self.width_us)
        own = [i for i, r in enumerate(rows) if r[3]]
        if own:
            yield pd.DataFrame(
                {
                    "source_event": [rows[i][1] for i in own],
                    "src_ip": key[0],
                    "ts_us": times[own],
                    "username": [rows[i][2] for i in own],
                    "n_events": counts[own],
                    "n_distinct": distinct[own],
                }
            )

    def close(self) -> None:
        pass


def rolling_count_stream(failed: DataFrame, *, width_us: int, watermark: str = "10 minutes") -> DataFrame:
    """Trailing counts per failed login, once the watermark has passed its chunk; the alert rules are filters on them.

    Needs ``source_event, src_ip, ts_us, event_time, username``. Rows later than the watermark are not counted; Spark
    reports how many (``numRowsDroppedByWatermark``).
    """
    chunk = F.floor(F.col("ts_us") / F.lit(width_us)).cast("bigint")
    return (
        failed.select("source_event", "src_ip", "ts_us", "event_time", "username")
        .withWatermark("event_time", watermark)
        .withColumn("own", F.explode(F.array(F.lit(True), F.lit(False))))
        .withColumn("chunk", chunk + F.when(F.col("own"), 0).otherwise(1))
        .groupBy("src_ip", "chunk")
        .transformWithStateInPandas(
            statefulProcessor=RollingCounts(width_us),
            outputStructType=(
                "source_event string, src_ip string, ts_us long, username string, n_events long, n_distinct long"
            ),
            outputMode="append",
            timeMode="EventTime",
        )
    )


def threshold_stream(matches: DataFrame, *, count: int = 5, seconds: int = 60, watermark: str = "1 minute") -> DataFrame:
    """One row per source and fixed interval with at least ``count`` matches, once the interval is over."""
    return (
        matches.withWatermark("event_time", watermark)
        .groupBy("src_ip", F.window("event_time", f"{seconds} seconds").alias("w"))
        .agg(F.count(F.lit(1)).alias("matches"), F.max("ts_us").alias("last_us"))
        .filter(F.col("matches") >= count)
        .select("src_ip", F.unix_micros("w.start").alias("window_us"), "matches", "last_us")
    )
