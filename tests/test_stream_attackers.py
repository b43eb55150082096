import datetime as dt

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pulsewatch.sources.streams import text_stream
from pulsewatch.streaming.attackers import Entries, attackers_stream, closed_frames, merged, one_line
from pulsewatch.streaming.jobs import StreamSpec, run_available

T0 = dt.datetime(2024, 1, 1)


def test_frames_are_counted_once_and_exactly():
    r = np.random.default_rng(1)
    for _ in range(200):
        frame = int(r.integers(1, 40))
        times = np.sort(r.choice(200, int(r.integers(1, 40)), replace=False))
        counts, done = r.integers(0, 5, len(times)), r.random(len(times)) < 0.3
        until = int(r.integers(0, 220))
        ends, totals = closed_frames(times, counts, frame, until, done)
        want = {int(t): int(counts[(times > t - frame) & (times <= t)].sum())
                for t, d in zip(times, done, strict=True) if t <= until and not d}
        assert dict(zip(ends.tolist(), totals.tolist(), strict=True)) == want


def test_entries_of_one_time_are_combined():
    times, counts, done = merged(np.array([5, 3, 5, 9]), np.array([1, 2, 3, 4]), np.array([True, True, False, True]))
    assert times.tolist() == [3, 5, 9] and counts.tolist() == [2, 4, 4] and done.tolist() == [True, False, True]


def _publish(spark, path, rows):
    """(user, seconds, value) messages in one file."""
    lines = [(f'{{"u":{"null" if u is None else repr(u).replace(chr(39), chr(34))},"s":{s},"v":{"null" if v is None else v}}}',)
             for u, s, v in rows]
    spark.createDataFrame(lines, "value string").coalesce(1).write.mode("append").text(path)


def _run(spark, base, threshold):
    rows = (text_stream(spark, f"{base}/topic").select(F.from_json("value", "u string, s double, v int").alias("r"))
            .select(F.col("r.u").alias("user_id"), F.col("r.v").alias("value"),
                    F.timestamp_micros((F.lit(int(T0.timestamp()) * 1_000_000) + F.col("r.s") * 1_000_000).cast("long"))
                    .alias("timestamp")))
    run_available([StreamSpec("attackers_test", attackers_stream(rows, "5 seconds", threshold, "2 seconds"), f"{base}/ckpt",
                              "parquet", options={"path": f"{base}/out"}, rocksdb=True, state_partitions=2)])
    out = spark.read.parquet(f"{base}/out").collect()
    return sorted((r["user_id"], (r["timestamp"] - T0).total_seconds(), r["rolling_count"]) for r in out)


def test_buffers_across_restarts_ties_late_rows_and_nulls(spark, scratch):
    rows = [("a", 1, 1), ("a", 1, 1), ("a", 2, 1), ("a", 6, 1), ("b", 3, 1), ("b", 3, None), (None, 3, 1), ("c", 7.5, 1)]
    _publish(spark, f"{scratch}/topic", rows)
    # The watermark is at 5.5: frames up to there are closed, a's at 6 is still open.
    assert _run(spark, scratch, 1) == [("a", 1.0, 2), ("a", 2.0, 3)]
    # One row at 4 is late and dropped, one at 6 joins the open frame, 20 closes everything else.
    _publish(spark, f"{scratch}/topic", [("a", 4, 1), ("a", 6, 1), ("b", 7, 1), ("c", 20, 1)])
    assert _run(spark, scratch, 1) == [("a", 1.0, 2), ("a", 2.0, 3), ("a", 6.0, 3), ("b", 7.0, 2)]
    # A user that was forgotten starts afresh.
    _publish(spark, f"{scratch}/topic", [("a", 21, 1), ("a", 21.000001, 1), ("c", 60, 1)])
    assert _run(spark, scratch, 1) == [("a", 1.0, 2), ("a", 2.0, 3), ("a", 6.0, 3), ("a", 21.000001, 2), ("b", 7.0, 2)]


def test_users_on_one_line_do_not_reach_each_other():
    users, times = np.array([1, 0, 1, 0, 1]), np.array([100, 7, 5, 9, 102])
    order, places = one_line(users, times, 10)
    assert order.tolist() == [1, 3, 2, 0, 4] and places.tolist() == [0, 2, 12, 22, 24]


def test_groups_of_users_are_counted_as_each_user_alone():
    r = np.random.default_rng(2)
    for _ in range(100):
        frame, n = int(r.integers(1, 40)), int(r.integers(1, 80))
        users, times = r.choice(["a", "b", "\u00e9", ""], n), r.integers(-50, 150, n)
        counts, done, until = r.integers(0, 5, n), r.random(n) < 0.3, int(r.integers(-60, 170))
        cut = int(r.integers(0, n + 1))
        held = [Entries(pa.array(users[p].tolist(), pa.string()), times[p], counts[p], done[p], frame).packed()
                for p in (slice(0, cut), slice(cut, n)) if len(users[p])]
        now = Entries.unpacked(held, frame)
        at, totals = now.close(until)
        got = {(now.names[int(now.codes[i])].as_py(), int(now.times[i])): int(c) for i, c in zip(at, totals, strict=True)}
        assert len(got) == len(at)
        assert got == {(u, t): int(counts[(users == u) & (times > t - frame) & (times <= t)].sum())
                       for u, t in set(zip(users.tolist(), times.tolist(), strict=True))
                       if t <= until and not done[(users == u) & (times == t)].all()}
        kept = now.times > until - frame
        if kept.any():
            again = Entries.unpacked([now.packed(kept)], frame)
            assert again.times.tolist() == now.times[kept].tolist() and again.done.tolist() == now.done[kept].tolist()


def test_state_follows_the_groups_not_the_users(spark, scratch):
    r = np.random.default_rng(3)
    users, seconds = [f"u{i}" for i in r.integers(0, 400, 1500)], np.round(r.random(1500) * 20, 3)
    rows = [(u, float(s), 1) for u, s in zip(users, seconds, strict=True)]
    _publish(spark, f"{scratch}/topic", rows)
    stream = (text_stream(spark, f"{scratch}/topic").select(F.from_json("value", "u string, s double, v int").alias("r"))
              .select(F.col("r.u").alias("user_id"), F.col("r.v").alias("value"),
                      F.timestamp_millis((F.lit(int(T0.timestamp()) * 1000) + F.round(F.col("r.s") * 1000)).cast("long"))
                      .alias("timestamp")))
    query, = run_available([StreamSpec("attackers_groups", attackers_stream(stream, "5 seconds", 2, "2 seconds", groups=4),
                                       f"{scratch}/ckpt", "parquet", options={"path": f"{scratch}/out"}, rocksdb=True,
                                       state_partitions=2)])
    got = {(x["user_id"], round((x["timestamp"] - T0).total_seconds() * 1000)): x["rolling_count"]
           for x in spark.read.parquet(f"{scratch}/out").collect()}
    ms, who = np.round(seconds * 1000).astype(int), np.array(users)
    count = {(u, int(t)): int(((who == u) & (ms > t - 5000) & (ms <= t)).sum()) for u, t in zip(users, ms, strict=True)}
    assert got == {k: n for k, n in count.items() if n > 2 and k[1] <= ms.max() - 2000} and got
    # One entry a chunk and group, and its timer.
    assert max(op["numRowsTotal"] for p in query.recentProgress for op in p["stateOperators"]) <= 4 * 4
