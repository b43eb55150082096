"""Filters and predicates (FLT1-6).

All are plain Catalyst predicates on stored columns, so they reach the
Parquet scan as pushed filters (the day filter included: ``to_date(ts) = d``
is rewritten to a range on ``ts``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import event_date


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def of_kind(df: DataFrame, kind: str, kind_col: str = "operation_type") -> DataFrame:
    """FLT1: equality on an event kind."""
    return df.filter(_c(kind_col) == F.lit(kind))


def of_kinds(df: DataFrame, kinds: Iterable[str], kind_col: str = "operation_type") -> DataFrame:
    """FLT2: set membership."""
    return df.filter(_c(kind_col).isin(list(kinds)))


def on_day(df: DataFrame, day: dt.date | str | Column, time_col: str = "timestamp") -> DataFrame:
    """FLT3: rows whose event time falls on one calendar day."""
    d = day if isinstance(day, Column) else F.lit(day).cast("date")
    return df.filter(event_date(time_col) == d)


def in_days(df: DataFrame, first: dt.date | str, last: dt.date | str,
            time_col: str = "timestamp") -> DataFrame:
    """FLT3 over a closed day range (archive catch-up)."""
    day = event_date(time_col)
    return df.filter(day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def above(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """FLT4: HAVING-style threshold, strictly greater."""
    return df.filter(F.col(column) > F.lit(threshold))


def labelled(df: DataFrame, label_col: str = "attack", label: int = 1) -> DataFrame:
    """FLT5: rows carrying a given label."""
    return df.filter(F.col(label_col) == F.lit(label))


def panel_range(
    df: DataFrame,
    id_col: str,
    ids: Iterable | None,
    time_col: str,
    time_from: dt.datetime | Column,
    time_to: dt.datetime | Column,
) -> DataFrame:
    """FLT6: id in a set and time strictly inside (from, to): both bounds open."""
    t = F.col(time_col)
    lo = time_from if isinstance(time_from, Column) else F.lit(time_from)
    hi = time_to if isinstance(time_to, Column) else F.lit(time_to)
    pred = (t > lo) & (t < hi)
    if ids is not None:
        pred = F.col(id_col).isin(list(ids)) & pred
    return df.filter(pred)
