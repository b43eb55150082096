"""Attackers on a stream (WIN2): rolling counts over arbitrary state.

A rolling frame has no window to group by, so the batch form (``operators.rolling``) cannot run on
a stream. Here each user has a bounded buffer: counts by event time, of the rows whose
frame is still open and of those that open frames reach back to. When the watermark passes an
event time t, every row of the frame (t - W, t] has arrived (later ones are dropped as late), so the
frame is counted, and a user above the threshold is reported. Times behind the watermark by more
than W are then forgotten. A user's buffer thus covers W plus the watermark's delay, whatever the
stream's length, one entry per distinct event time.

A call into a stateful processor costs milliseconds, whatever it does. So the state's key is not a user but
a group of users, by a hash: the number of calls follows the groups, and their work is done on arrays over
all users of a group. One timer per group, at its earliest open time, wakes the group up; arriving rows are only
added to the state. Rows of a micro-batch reach the group in Arrow chunks and are combined by user and time before
they are stored, a chunk as one entry. A task holds one group's buffers at a time; more groups make them smaller.
Spark offers arbitrary state in Python as a stateful processor only: this is the one part of the
telemetry library that runs in Python workers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.timefn import duration_micros

OUTPUT = "user_id string, timestamp timestamp, rolling_count bigint"
# Groups of users a stream starts with: several for every state partition, of some ten thousand entries in a busy frame.
GROUPS = 1024
_BUFFER = "entries binary"
_ENTRIES = pa.schema([("user_id", pa.string()), ("t", pa.int64()), ("n", pa.int64()), ("done", pa.bool_())])


def closed_frames(times: np.ndarray, counts: np.ndarray, frame_us: int, until: int, done: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray]:
    """(times, rolling counts) of the open frames that end at or before ``until``.

    ``times`` ascend and are distinct, in microseconds; ``done`` marks frames counted before.
    """
    running = np.concatenate([[0], np.cumsum(counts)])
    now = np.flatnonzero((times <= until) & ~done)
    first = np.searchsorted(times, times[now] - frame_us, "right")
    return times[now], running[now + 1] - running[first]


def merged(times: np.ndarray, counts: np.ndarray, done: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry per time, ascending; a time stays done only if no open row joined it."""
    distinct, back = np.unique(times, return_inverse=True)
    total = np.bincount(back, counts, len(distinct)).astype(np.int64)
    waiting = np.bincount(back, ~done, len(distinct)) > 0
    return distinct, total, ~waiting


def one_line(users: np.ndarray, times: np.ndarray, frame_us: int) -> tuple[np.ndarray, np.ndarray]:
    """(order by user and time, places in that order): the times of all users on one line.

    Entries of one user that are nearer than a frame keep their distance, all other neighbours are a frame
    apart. So no frame on the line reaches another user, and only entries of one user and time share a place.
    """
    order = np.lexsort((times, users))
    users, times = users[order], times[order]
    steps = np.where(np.diff(users) == 0, np.minimum(np.diff(times), frame_us), frame_us)
    return order, np.concatenate([[0], np.cumsum(steps)])


class Entries:
    """Counts by user and event time of a group, one entry each, by user and time."""

    def __init__(self, users: pa.Array, times: np.ndarray, counts: np.ndarray, done: np.ndarray, frame_us: int):
        coded = users.dictionary_encode()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        order, places = one_line(codes, times, frame_us)
        self.places, self.counts, self.done = merged(places, counts[order], done[order])
        first = order[np.searchsorted(places, self.places)]
        self.names, self.codes, self.times, self.frame_us = coded.dictionary, codes[first], times[first], frame_us

    @classmethod
    def unpacked(cls, held: list[bytes], frame_us: int) -> Entries:
        table = pa.concat_tables(pa.ipc.open_stream(b).read_all() for b in held)
        t, n, done = (table[c].to_numpy() for c in ("t", "n", "done"))
        return cls(pa.concat_arrays(table["user_id"].chunks), t, n, done, frame_us)

    def packed(self, which: np.ndarray | None = None) -> bytes:
        at = np.arange(len(self.times)) if which is None else np.flatnonzero(which)
        batch = pa.record_batch([self.names.take(pa.array(self.codes[at])), pa.array(self.times[at]),
                                 pa.array(self.counts[at]), pa.array(self.done[at])], schema=_ENTRIES)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _ENTRIES) as out:
            out.write_batch(batch)
        return sink.getvalue().to_pybytes()

    def close(self, until: int) -> tuple[np.ndarray, np.ndarray]:
        """(entries, rolling counts) of the open frames that end at or before ``until``; they are done then."""
        settled = self.done | (self.times > until)
        _, totals = closed_frames(self.places, self.counts, self.frame_us, int(self.places[-1]), settled)
        self.done |= self.times <= until
        return np.flatnonzero(~settled), totals


class RollingCounter(StatefulProcessor):
    """Reports the closed frames of a group's users whose count exceeds the threshold."""

    def __init__(self, frame_us: int, threshold: int):
        self.frame_us, self.threshold = frame_us, threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buffer = handle.getListState("buffer", _BUFFER)

    def _wake_at(self, time_us: int) -> None:
        """Keep one timer, at the first whole millisecond by which ``time_us`` has passed."""
        wanted = -(-time_us // 1000)
        set_for = list(self.handle.listTimers())
        if not set_for or wanted < min(set_for):
            for timer in set_for:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(wanted)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        least = None
        for chunk in rows:
            if not len(chunk):
                continue
            times = chunk["t"].to_numpy(np.int64)
            new = Entries(pa.array(chunk["user_id"], pa.string()), times, chunk["counted"].to_numpy(np.int64),
                          np.zeros(len(times), bool), self.frame_us)
            self.buffer.appendValue((new.packed(),))
            least = int(times.min()) if least is None else min(least, int(times.min()))
        if least is not None:
            self._wake_at(least)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        until = timerValues.getCurrentWatermarkInMs() * 1000
        held = [bytes(entries) for (entries,) in self.buffer.get()]
        if not held:
            return
        now = Entries.unpacked(held, self.frame_us)
        at, totals = now.close(until)
        kept = now.times > until - self.frame_us
        if kept.any():
            self.buffer.put([(now.packed(kept),)])
            waiting = now.times[kept & ~now.done]
            # A group whose frames are all counted is woken once more, to forget them.
            self._wake_at(int(waiting.min()) if len(waiting) else int(now.times.max()) + self.frame_us)
        else:
            self.buffer.clear()
        over = totals > self.threshold
        if over.any():
            at, totals = at[over], totals[over]
            yield pd.DataFrame({"user_id": now.names.take(pa.array(now.codes[at])).to_pandas(),
                                "timestamp": pd.to_datetime(now.times[at], unit="us"),
                                "rolling_count": totals})

    def close(self) -> None:
        pass


def attackers_stream(events: DataFrame, frame: str = "5 seconds", threshold: int = 50, delay: str = "5 seconds",
                     user_col: str = "user_id", time_col: str = "timestamp", value_col: str = "value",
                     groups: int = GROUPS) -> DataFrame:
    """WIN2 on a stream: user (as text), time and count of every closed frame above ``threshold``.

    As in the batch form rows with a null ``value_col`` do not count, and rows without a user or a time belong to no
    frame. ``max(rolling_count)`` per user is the batch form's peak count over closed frames. ``groups`` is
    fixed for the life of a checkpoint; raise it for a busier stream or more state partitions.
    """
    rows = (events.filter(F.col(user_col).isNotNull() & F.col(time_col).isNotNull())
            .withWatermark(time_col, delay)
            .select(F.col(user_col).cast("string").alias("user_id"), F.col(time_col),
                    F.unix_micros(time_col).alias("t"), F.col(value_col).isNotNull().cast("long").alias("counted"))
            .withColumn("users", F.pmod(F.xxhash64("user_id"), F.lit(groups)).cast("int")))
    return rows.groupBy("users").transformWithStateInPandas(
        statefulProcessor=RollingCounter(duration_micros(frame), threshold), outputStructType=OUTPUT,
        outputMode="append", timeMode="eventTime")
