"""Sorts, top-n, clustered layout and batch union (SRT1-3, SET1)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sort_by_time(df: DataFrame, time_col: str = "timestamp", *ties: str) -> DataFrame:
    """SRT1: total order by event time (ties broken by the given columns)."""
    return df.orderBy(time_col, *ties)


def top_n(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """SRT2: first ``n`` rows of a total order.

    Planned as TakeOrderedAndProject: each task keeps its own top ``n`` and
    only those are merged, so the cost does not grow with the table.
    """
    return df.orderBy(*order).limit(n)


def newest_first(df: DataFrame, n: int | None = None, time_col: str = "timestamp",
                 *ties: str) -> DataFrame:
    """SRT2/SRT3 on read: newest (then largest tie) first, optionally the top ``n``."""
    order = [F.col(time_col).desc(), *[F.col(t).desc() for t in ties]]
    return top_n(df, n, order) if n is not None else df.orderBy(*order)


def top_n_per_key(df: DataFrame, n: int, key: str, order: Sequence[Column | str], out_col: str = "place") -> DataFrame:
    """SRT2/SRT3 for every key: the first ``n`` rows of each in a total order, with their place from 1.

    Spark plans the limit on the row number as a group limit on both sides of the
    shuffle: every map task passes on at most ``n`` rows of a key, so a key that holds a
    third of all rows reaches its task as ``n`` rows per map task, not whole. Rows with
    a null key form a group of their own.
    """
    numbered = df.withColumn(out_col, F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("long"))
    return numbered.filter(F.col(out_col) <= n)


def clustered(df: DataFrame, partition_col: str, order: Sequence[tuple[str, bool]],
              partitions: int | None = None) -> DataFrame:
    """SRT3 on write: rows of one partition key together, in clustering order.

    Range partitioning on (key, clustering columns) plus a sort inside each
    task: each output file holds one contiguous run of keys in clustering
    order, and a hot key spans several tasks instead of one (a hash
    partition on the key alone would give it a single task).
    """
    cols = [F.col(partition_col)] + [F.col(c).desc() if d else F.col(c).asc() for c, d in order]
    parts = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return parts.sortWithinPartitions(*cols)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """SET1: append batches by column name (UNION ALL, no dedup)."""
    return reduce(lambda a, b: a.unionByName(b), frames)
