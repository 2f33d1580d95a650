"""Executions on a stream, open ones included: sessions kept as intervals in state, merged as rows come.

A session grows, joins another that a late row connects it with, or starts earlier than was known. Each micro-batch gives
the sessions that it changed, and a session that went up in another one comes once more with `n_runs` 0. So the newest
version of every (key, started_at) that has rows is the state of all sessions at any time; nothing waits for a watermark.
The watermark only bounds the state: what no row can change any more is forgotten, by an event-time timer where a key has
gone quiet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.streaming.events import timed

#: First time, last time (both in microseconds) and number of rows.
Session = tuple[int, int, int]


def cut(times: np.ndarray, gap: int) -> list[Session]:
    """Sessions of times in any order: pauses of more than `gap` part them."""
    if not len(times):
        return []
    times = np.sort(times)
    starts = np.flatnonzero(np.diff(times, prepend=times[0]) > gap)
    starts = np.concatenate([[0], starts])
    ends = np.append(starts[1:], len(times))
    return [(int(times[a]), int(times[b - 1]), int(b - a)) for a, b in zip(starts, ends)]


def merged(sessions: list[Session], gap: int) -> list[Session]:
    """Sessions joined where the pause between them is no longer than `gap`."""
    out: list[Session] = []
    for first, last, n in sorted(sessions):
        if out and first - out[-1][1] <= gap:
            out[-1] = (out[-1][0], max(out[-1][1], last), out[-1][2] + n)
        else:
            out.append((first, last, n))
    return out


def cut_keys(keys: np.ndarray, times: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sessions of many keys at once: key, first time, last time and number of rows of each, in order of key and time."""
    order = np.lexsort((times, keys))
    keys, times = keys[order], times[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (np.diff(times) > gap)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(keys))
    return keys[starts], times[starts], times[ends - 1], ends - starts


class OpenSessions(StatefulProcessor):
    """Sessions that a row can still change, by key, for all keys of a bucket.

    The sessions of a key are one value, so a key costs one read and one write in a micro-batch that has rows of it,
    however many sessions it has; the other keys of the bucket are not touched.
    """

    def __init__(self, gap: int, fields: list[str]) -> None:
        self.gap, self.fields = gap, fields

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "session_key string", "sessions binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        fresh: dict[str, list[Session]] = {}
        for pdf in rows:
            codes, names = pd.factorize(pdf["session_key"])
            found = cut_keys(codes, pdf["event_micros"].to_numpy(), self.gap)
            for code, *session in zip(*(v.tolist() for v in found), strict=True):
                fresh.setdefault(names[code], []).append(tuple(session))
        out, watermark, newest = [], self._watermark(timer_values), None
        for name, own in fresh.items():
            held = self._unpacked(self.open.getValue((name,)))
            after = merged([*held, *own], self.gap)
            before = {first: (last, n) for first, last, n in held}
            gone = before.keys() - {first for first, _, _ in after}
            out += [(name, first, before[first][0], 0) for first in sorted(gone)]
            out += [(name, first, last, n) for first, last, n in after if before.get(first) != (last, n)]
            newest = after[-1][1] if newest is None else max(newest, after[-1][1])
            self._keep(name, after, watermark, bool(held))
        if newest is not None:
            # A row is dropped from the watermark on, so the last session may be forgotten one gap after it ended.
            self.handle.registerTimer((newest + self.gap) // 1000 + 1)
        yield pd.DataFrame(out, columns=self.fields)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = self._watermark(timerValues)
        for (name,), (held,) in list(self.open.iterator()):
            self._keep(name, self._unpacked(held), watermark, True)
        yield pd.DataFrame([], columns=self.fields)

    def _keep(self, name: str, sessions: list[Session], watermark: int, held: bool) -> None:
        """Store the sessions that are not closed at the watermark; a key without any is forgotten."""
        still = [s for s in sessions if s[1] + self.gap >= watermark]
        if still:
            self.open.updateValue((name,), (np.array(still, "<i8").tobytes(),))
        elif held:
            self.open.removeKey((name,))

    @staticmethod
    def _unpacked(value) -> list[Session]:
        blob = value[0] if isinstance(value, tuple) else value
        return [tuple(s) for s in np.frombuffer(blob, "<i8").reshape(-1, 3).tolist()] if blob else []

    @staticmethod
    def _watermark(timer_values) -> int:
        return timer_values.getCurrentWatermarkInMs() * 1000

    def close(self) -> None:
        pass


def open_sessions(
    events: DataFrame, keys: list[str], gap_seconds: int, ts: str = "ts", delay: str = "1 day", buckets: int = 4096
) -> DataFrame:
    """(keys, started_at, ended_at, n_runs) of every session that a micro-batch changed; update mode, see `sinks.run_latest`.

    Rows without a time are left out. Rows that come after the watermark are dropped and counted by the engine. The keys are
    dealt to `buckets`: the rows of a bucket meet in one task of a micro-batch, where they are cut into sessions at once.
    """
    # One text stands for all keys, so that a null key is a key and numbers stay whole on their way through pandas.
    form = T.StructType([events.schema[k] for k in keys])
    one_key = F.to_json(F.struct(*keys)).alias("session_key")
    rows = timed(events.filter(F.col(ts).isNotNull()), ts, delay).select(one_key, ts, F.unix_micros(ts).alias("event_micros"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("session_key"), F.lit(buckets)))
    fields = ["session_key", "first", "last", "n_runs"]
    changed = rows.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=OpenSessions(gap_seconds * 1_000_000, fields),
        outputStructType="session_key string, first bigint, last bigint, n_runs bigint",
        outputMode="update",
        timeMode="eventtime",
    )
    return changed.withColumn("_k", F.from_json("session_key", form)).select(
        *[F.col(f"_k.{k}").alias(k) for k in keys],
        F.timestamp_micros("first").alias("started_at"),
        F.timestamp_micros("last").alias("ended_at"),
        "n_runs",
    )
