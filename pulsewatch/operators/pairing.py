"""Positional pairing of two event kinds, per key and over whole tables (JOI1).

The k-th row of the left kind is paired with the k-th row of the right kind
of the same key (order: event time, then tie-breaking ids); surplus rows of
the longer side are dropped (inner join).

Row numbers per key are computed without putting a key in one task: event
time is cut into buckets; a row's number is its number inside its (key,
bucket, kind) plus the kind's row count in the key's earlier buckets. The
rows of both kinds are read and shuffled together, once, on (key, bucket).
The bucket totals are a partial aggregate of key, time and kind alone; only they are
windowed by key (one row per key and bucket). Both sides of a pair then meet
in one aggregation on (key, number), not in a join.

:func:`pair_tables` pairs whole tables: both get a global index
(:mod:`.indexing`), on which they are joined. An index holds each number
once, so the join has no hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefn import duration_micros, to_micros
from .indexing import row_index

BUCKET = "1 hour"


def rank_within(
    df: DataFrame,
    key: str,
    time_col: str,
    tie_cols: Sequence[str] = (),
    bucket: str = BUCKET,
    out_col: str = "rn",
    kind_col: str | None = None,
    kinds: Sequence = (),
) -> DataFrame:
    """1-based row number per ``key`` (and each of ``kinds``) ordered by (time, *ties).

    Give ties that make the order total (e.g. a unique id) for a result that
    is the same on every run and retry. Rows with a null key or time are left out.
    """
    b_us = duration_micros(bucket)
    d = (df.withColumn("_t", to_micros(time_col))
         .withColumn("_b", F.expr(f"(_t - pmod(_t, {b_us})) div {b_us}")))
    by = [kind_col] if kind_col else []
    local = d.repartition(key, "_b").withColumn(
        "_lrn", F.row_number().over(Window.partitionBy(key, "_b", *by).orderBy("_t", *tie_cols)))
    # Per kind one count, so that the totals join on the rows' (key, bucket) partitioning.
    tests = [F.col(kind_col) == F.lit(k) for k in kinds] if kind_col else [F.lit(True)]
    earlier = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = d.groupBy(key, "_b").agg(*[F.count(F.when(t, 1)).alias(f"_n{i}") for i, t in enumerate(tests)])
    offsets = totals.select(key, "_b", *[
        F.coalesce(F.sum(f"_n{i}").over(earlier), F.lit(0)).alias(f"_o{i}") for i in range(len(tests))])
    offset = F.coalesce(*[F.when(t, F.col(f"_o{i}")) for i, t in enumerate(tests)])
    return (local.join(offsets, [key, "_b"])
            .withColumn(out_col, offset + F.col("_lrn"))
            .select(*df.columns, out_col))


def pair_kinds(
    df: DataFrame,
    kind_col: str,
    left: object,
    right: object,
    key: str,
    time_col: str,
    tie_cols: Sequence[str] = (),
    left_prefix: str = "left_",
    right_prefix: str = "right_",
    bucket: str = BUCKET,
) -> DataFrame:
    """JOI1: the k-th ``left`` row with the k-th ``right`` row of each key, in one scan.

    Output: ``key``, ``rn``, then every other column of each side with its
    prefix. Rows with a null key pair with nothing.
    """
    payload = [c for c in df.columns if c not in (key, kind_col)]
    rows = df.filter(F.col(key).isNotNull() & F.col(kind_col).isin([left, right]))
    ranked = rank_within(rows, key, time_col, tie_cols, bucket, kind_col=kind_col, kinds=[left, right])
    row = F.struct(*payload)
    sides = ranked.groupBy(key, "rn").agg(*[
        F.max(F.when(F.col(kind_col) == F.lit(kind), row)).alias(name)
        for kind, name in ((left, "_left"), (right, "_right"))])
    return sides.filter(F.col("_left").isNotNull() & F.col("_right").isNotNull()).select(
        key, "rn",
        *[F.col(f"_left.{c}").alias(left_prefix + c) for c in payload],
        *[F.col(f"_right.{c}").alias(right_prefix + c) for c in payload])


def positional_pair(
    left: DataFrame,
    right: DataFrame,
    key: str,
    time_col: str,
    tie_cols: Sequence[str] = (),
    left_prefix: str = "left_",
    right_prefix: str = "right_",
    bucket: str = BUCKET,
) -> DataFrame:
    """JOI1 for two frames with the same columns."""
    both = left.withColumn("_side", F.lit("left")).unionByName(right.withColumn("_side", F.lit("right")))
    return pair_kinds(both, "_side", "left", "right", key, time_col, tie_cols, left_prefix, right_prefix, bucket)


def pair_tables(
    left: DataFrame,
    right: DataFrame,
    left_order: Sequence[Column | str],
    right_order: Sequence[Column | str],
    left_prefix: str = "left_",
    right_prefix: str = "right_",
    strict: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """JOI1 over whole tables: the i-th row of ``left`` with the i-th row of ``right``.

    Output: ``rn`` (from 1), then every column of each side with its prefix; the two sides may have
    different columns. Rows of the longer side beyond the shorter one's
    length are dropped; with ``strict`` unequal lengths raise ValueError instead.
    """
    def numbered(df: DataFrame, order: Sequence[Column | str], prefix: str) -> DataFrame:
        indexed = row_index(df, order, "rn", 1, partitions)
        return indexed.select("rn", *[F.col(f"`{c}`").alias(prefix + c) for c in indexed.columns if c != "rn"])

    one, two = numbered(left, left_order, left_prefix), numbered(right, right_order, right_prefix)
    if strict:
        n, m = one.count(), two.count()
        if n != m:
            raise ValueError(f"cannot pair {n} rows with {m} rows by position")
    return one.join(two, "rn")
