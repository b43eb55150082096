"""Event time: watermark and tumbling windows (EVT1, EVT2).

Windows are epoch-aligned and half-open, [start, end). The same column
expression serves a batch and a streaming aggregate; in a stream the
watermark decides when a window is final (append mode emits it once, when
the watermark passes its end, and drops rows that arrive later).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_watermark(df: DataFrame, delay: str, time_col: str = "timestamp") -> DataFrame:
    """EVT1: bound lateness. Event time must be TIMESTAMP (not _NTZ) here."""
    return df.withWatermark(time_col, delay)


def tumbling(width: str, time_col: str = "timestamp") -> Column:
    """EVT2: epoch-aligned tumbling window of ``width`` over ``time_col``."""
    return F.window(F.col(time_col), width)


def window_key(df: DataFrame, width: str, time_col: str = "timestamp") -> Column:
    """Grouping key for a tumbling-window aggregate of ``df``, aliased ``window``.

    A stream groups by the window struct, which carries the watermark that
    lets state be evicted. A batch groups by the window start alone: a scalar
    key hashes and compares faster than a struct; the values are equal.
    Read the start with :func:`window_start_of`.
    """
    w = tumbling(width, time_col)
    return (w if df.isStreaming else w.start).alias("window")


def window_start_of(df: DataFrame, alias: str = "timestamp") -> Column:
    """Start of the ``window`` key produced by :func:`window_key`."""
    is_struct = df.schema["window"].dataType.typeName() == "struct"
    return (F.col("window.start") if is_struct else F.col("window")).alias(alias)
