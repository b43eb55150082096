import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from pulsewatch.operators.rolling import attackers, peak_rolling_count, rolling_count
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)


def _frame(spark, rows):
    return spark.createDataFrame(
        [(u, T0 + dt.timedelta(seconds=s), v) for u, s, v in rows],
        "user_id string, timestamp timestamp, value int",
    )


def test_rolling_count_left_open_frame(spark):
    df = _frame(spark, [("u", s, 0) for s in [0, 0, 1, 4, 5, 9]])
    out = sorted((r["timestamp"], r["rolling_count"]) for r in rolling_count(df, "5 seconds").collect())
    assert [c for _, c in out] == [2, 2, 3, 4, 3, 2]


def _detector_rows():
    rows = [("A", 0.5, 0)] * 51                                     # 51 within one second
    rows += [("B", 0.0, 0)] * 50                                    # exactly 50: not flagged
    rows += [("C", 0.0, 0)] + [("C", 5.0, 0)] * 50                  # first is 5 s before last
    rows += [("D", 1.0, 0)] * 50 + [("D", 1.0, None)] * 10          # nulls are not counted
    return rows


def test_detector_cases(spark):
    df = _frame(spark, _detector_rows())
    assert [r["user_id"] for r in attackers(df, "5 seconds", 50).collect()] == ["A"]
    peaks = {r["user_id"]: r["peak_count"] for r in peak_rolling_count(df, "5 seconds").collect()}
    assert peaks == {"A": 51, "B": 50, "C": 50, "D": 50}


def _pandas_rolling(pdf: pd.DataFrame, frame: str) -> dict:
    """Brute force: per row, rows of the same user in (t - frame, t], ties included."""
    w = pd.Timedelta(frame)
    out = {}
    for _, g in pdf.groupby("user_id"):
        ts = g["ts"].to_numpy()
        for eid, t in zip(g["event_id"], ts):
            out[eid] = int(((ts > t - w) & (ts <= t)).sum())
    return out


def test_rolling_matches_brute_force_for_any_bucket(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "user_id", "ts", "value")
    truth = _pandas_rolling(ev.toPandas(), "1 hour")
    for bucket in [None, "1 second", "1 hour", "2 hours", "1 day"]:
        got = {r["event_id"]: r["rolling_count"]
               for r in rolling_count(ev, "1 hour", "user_id", "ts", bucket=bucket).collect()}
        assert got == truth, bucket


def test_widening_the_frame_never_lowers_a_count(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "user_id", "ts", "value")
    a = rolling_count(ev, "1 hour", "user_id", "ts").withColumnRenamed("rolling_count", "a")
    b = rolling_count(ev, "1 day", "user_id", "ts").select("event_id", F.col("rolling_count").alias("b"))
    assert a.join(b, "event_id").filter(F.col("b") < F.col("a")).count() == 0


def test_hot_user_is_split_across_tasks(spark):
    """A single user spread over many buckets lands in many window partitions."""
    rows = [("hot", s * 3600.0, 0) for s in range(48)]
    df = _frame(spark, rows)
    out = rolling_count(df, "1 hour")
    assert out.count() == 48
    assert {r["rolling_count"] for r in out.collect()} == {1}


def test_window_is_partitioned_by_user_and_bucket(spark):
    df = _frame(spark, [("u", 0, 0)])
    plan = rolling_count(df, "5 seconds")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(user_id" in plan and "_bucket" in plan.split("hashpartitioning(")[1].split(")")[0]


def test_null_key_or_time_is_left_out(spark):
    rows = [("u", T0, 0), ("u", T0 + dt.timedelta(seconds=1), 0), (None, T0, 0), ("u", None, 0)]
    df = spark.createDataFrame(rows, "user_id string, timestamp timestamp, value int")
    out = sorted(r["rolling_count"] for r in rolling_count(df, "5 seconds").collect())
    assert out == [1, 2]
    assert {r["user_id"]: r["peak_count"] for r in peak_rolling_count(df, "5 seconds").collect()} == {"u": 2}


def test_one_user_with_a_third_of_the_rows_in_one_minute(spark):
    import random

    r = random.Random(5)
    rows = [("hot", r.uniform(0, 60), 0) for _ in range(300)] + [(f"u{i % 40}", r.uniform(0, 86400), 0) for i in range(600)]
    df = _frame(spark, rows)
    want = {}
    for u, t, _ in rows:
        n = sum(1 for u2, t2, _ in rows if u2 == u and t - 5 < t2 <= t)
        want[u] = max(want.get(u, 0), n)
    got = {x["user_id"]: x["peak_count"] for x in peak_rolling_count(df, "5 seconds").collect()}
    assert got == want


def test_one_scan_and_one_shuffle(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "user_id", "ts", "value")
    plan = rolling_count(ev, "1 day", "user_id", "ts")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1
