"""Rolling event counts per user and the attacker rule (WIN1, WIN2).

WIN1 counts, for every row, the same user's rows with a non-null value in
the frame (t - W, t] (left-open, like a pandas time-based rolling window).
Spark's RANGE frame counts tied timestamps as peers; the per-tie maximum,
and so WIN2's user set, is the same.

Skew: partitioning such a window by user alone would put a hot user (an
attacker may send a third of all rows) in one task. Instead a user is split
by event time: rows are partitioned by (user, bucket of width B), and a row
at t is also copied into the next bucket if that bucket's first rows still
see it, i.e. if it covers part of [t, t + W). Every bucket then holds the
whole frame of its own rows; copies are counted but not emitted. The cost is
one scan, one shuffle and about 1 + W / B rows per row; a task holds one
user's rows over B + W of event time. B is ``bucket``, by default
:data:`FRAMES_PER_BUCKET` frames: a wider bucket copies fewer rows, a narrower
one splits a hot user further (never below the frame itself).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefn import duration_micros, to_micros
from .filters import above

FRAMES_PER_BUCKET = 4


def _usable(df: DataFrame, partition_col: str, time_col: str) -> DataFrame:
    """Rows with a key and an event time; others belong to no user's frame
    (``functions.decode.split_decoded`` rejects them upstream)."""
    return df.filter(F.col(partition_col).isNotNull() & F.col(time_col).isNotNull())


def _bucket_width(frame_us: int, bucket: str | None) -> int:
    return max(frame_us, duration_micros(bucket) if bucket else FRAMES_PER_BUCKET * frame_us)


def _bucketed(df: DataFrame, time_col: str, frame_us: int, bucket_us: int) -> DataFrame:
    """Add ``_t`` (micros), ``_home`` bucket and the exploded ``_bucket`` copies."""
    home = F.expr(f"(_t - pmod(_t, {bucket_us})) div {bucket_us}")
    last = F.expr(f"(_t + {frame_us - 1} - pmod(_t + {frame_us - 1}, {bucket_us})) div {bucket_us}")
    return (
        df.withColumn("_t", to_micros(time_col))
        .withColumn("_home", home)
        .withColumn("_bucket", F.explode(F.sequence(F.col("_home"), last)))
    )


def _frame(partition_col: str, frame_us: int):
    return (Window.partitionBy(partition_col, "_bucket").orderBy("_t")
            .rangeBetween(-(frame_us - 1), 0))


def rolling_count(
    df: DataFrame,
    frame: str = "5 seconds",
    partition_col: str = "user_id",
    time_col: str = "timestamp",
    value_col: str = "value",
    out_col: str = "rolling_count",
    bucket: str | None = None,
) -> DataFrame:
    """WIN1: per row, count of ``value_col`` over (t - frame, t] per partition.

    Rows with a null key or event time are left out.
    """
    w_us = duration_micros(frame)
    exploded = _bucketed(_usable(df, partition_col, time_col), time_col, w_us, _bucket_width(w_us, bucket))
    return (
        exploded.withColumn(out_col, F.count(value_col).over(_frame(partition_col, w_us)))
        .filter(F.col("_bucket") == F.col("_home"))
        .drop("_t", "_home", "_bucket")
    )


def peak_rolling_count(
    df: DataFrame,
    frame: str = "5 seconds",
    partition_col: str = "user_id",
    time_col: str = "timestamp",
    value_col: str = "value",
    bucket: str | None = None,
) -> DataFrame:
    """Largest rolling count per partition key: ``<partition_col>``, ``peak_count``.

    Rows are first pre-aggregated to one row per (key, event time) with
    map-side partial aggregation, so a burst of equal times travels as one
    row; the rolling sum then runs over those counts, which gives the same
    per-time value (RANGE frames see all peers). Rows with a null key or
    event time are left out.
    """
    w_us = duration_micros(frame)
    per_time = (_usable(df, partition_col, time_col)
                .groupBy(partition_col, F.col(time_col).alias("_ts")).agg(F.count(value_col).alias("_n")))
    exploded = _bucketed(per_time, "_ts", w_us, _bucket_width(w_us, bucket))
    return (
        exploded.withColumn("_rolling", F.sum("_n").over(_frame(partition_col, w_us)))
        .filter(F.col("_bucket") == F.col("_home"))
        .groupBy(partition_col)
        .agg(F.max("_rolling").alias("peak_count"))
    )


def attackers(
    df: DataFrame,
    frame: str = "5 seconds",
    threshold: int = 50,
    partition_col: str = "user_id",
    time_col: str = "timestamp",
    value_col: str = "value",
    bucket: str | None = None,
    sort: bool = True,
) -> DataFrame:
    """WIN2 (+ FLT4, AGG5): users whose rolling count ever exceeds ``threshold``.

    Output: ``<partition_col>``, ``peak_count``, sorted by the key unless
    ``sort`` is False (a consumer that joins or aggregates skips the sort).
    """
    peaks = peak_rolling_count(df, frame, partition_col, time_col, value_col, bucket)
    flagged = above(peaks, "peak_count", threshold)
    return flagged.orderBy(partition_col) if sort else flagged
