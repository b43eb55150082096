"""Windowed and plain aggregations (AGG1-5).

Every aggregate is declared once and runs unchanged in batch and in a
stream. Spark plans each as partial aggregation -> shuffle on the grouping
key -> final aggregation, so a hot user or window is combined map-side before
the shuffle and never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import TRANSACTION_KINDS
from .filters import of_kind, of_kinds
from .windows import window_key, window_start_of


def distinct_count(column: str, mode: str = "approx", rsd: float | None = None) -> Column:
    """AGG3: distinct count. 'approx' is HLL++ (the only form a stream allows)."""
    if mode == "approx":
        return F.approx_count_distinct(column, rsd) if rsd else F.approx_count_distinct(column)
    if mode == "exact":
        return F.count_distinct(F.col(column))
    raise ValueError(f"unknown distinct mode {mode!r}")


def windowed_counts(
    df: DataFrame,
    width: str,
    count_name: str,
    time_col: str = "timestamp",
    user_col: str = "user_id",
    distinct: str | None = "approx",
    series_id: str | None = "1",
) -> DataFrame:
    """Rows per tumbling window plus distinct users.

    Output: ``timestamp`` (window start), ``<count_name>``,
    ``distinct_users`` (unless ``distinct`` is None), ``dummy_id``.
    """
    aggs = [F.count(F.lit(1)).alias(count_name)]
    if distinct:
        aggs.append(distinct_count(user_col, distinct).alias("distinct_users"))
    grouped = df.select(time_col, user_col).groupBy(window_key(df, width, time_col)).agg(*aggs)
    out = grouped.select(window_start_of(grouped), count_name,
                         *(["distinct_users"] if distinct else []))
    if series_id is not None:
        out = out.withColumn("dummy_id", F.lit(series_id))
    return out


def views_per_window(
    df: DataFrame,
    width: str = "1 minute",
    view_kind: str = "VIEW",
    kind_col: str = "operation_type",
    distinct: str | None = "approx",
    **kw,
) -> DataFrame:
    """AGG1: VIEW events per window with distinct users (FLT1 -> EVT2)."""
    return windowed_counts(of_kind(df, view_kind, kind_col), width, "views",
                           distinct=distinct, **kw)


def transactions_per_window(
    df: DataFrame,
    width: str = "1 minute",
    kinds: Iterable[str] = TRANSACTION_KINDS,
    kind_col: str = "operation_type",
    distinct: str | None = "approx",
    **kw,
) -> DataFrame:
    """AGG2: events of the transaction kinds per window (FLT2 -> EVT2)."""
    return windowed_counts(of_kinds(df, kinds, kind_col), width, "transactions",
                           distinct=distinct, **kw)


def burst_counts(
    df: DataFrame,
    width: str = "5 seconds",
    user_col: str = "user_id",
    action_col: str = "action_id",
    time_col: str = "timestamp",
    series_id: str | None = "1",
) -> DataFrame:
    """AGG4: events per (user, action, tumbling window).

    Output: ``timestamp``, ``action_id``, ``user_id``, ``count``, ``dummy_id``.
    """
    grouped = (
        df.select(time_col, action_col, user_col)
        .groupBy(F.col(user_col), F.col(action_col), window_key(df, width, time_col))
        .count()
    )
    out = grouped.select(window_start_of(grouped), F.col(action_col).alias("action_id"),
                         F.col(user_col).alias("user_id"), "count")
    if series_id is not None:
        out = out.withColumn("dummy_id", F.lit(series_id))
    return out


def distinct_by_day(
    df: DataFrame,
    mode: str = "exact",
    time_col: str = "timestamp",
    user_col: str = "user_id",
) -> DataFrame:
    """AGG3 per calendar day: ``event_date``, ``distinct_users``."""
    return (
        df.groupBy(F.to_date(time_col).alias("event_date"))
        .agg(distinct_count(user_col, mode).alias("distinct_users"))
    )


def distinct_within_bound(
    df: DataFrame,
    rel: float = 0.15,
    time_col: str = "timestamp",
    user_col: str = "user_id",
) -> DataFrame:
    """AGG3 check: per day, is the HLL estimate within ``rel`` of the exact count?

    Both counts come from one aggregation (one shuffle). Output:
    ``event_date``, ``within_bound`` (boolean).
    """
    g = df.groupBy(F.to_date(time_col).alias("event_date")).agg(
        F.approx_count_distinct(user_col).alias("approx"),
        F.count_distinct(F.col(user_col)).alias("exact"),
    )
    bound = F.greatest(F.lit(1.0), F.lit(rel) * F.col("exact"))
    return g.select("event_date", (F.abs(F.col("approx") - F.col("exact")) <= bound).alias("within_bound"))
