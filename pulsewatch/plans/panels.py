"""Dashboard panel queries, re-aimed as batch operators (PNL1, PNL2).

PNL1 builds a time series (id, value, time) from column names; PNL2 runs
SQL text with the time macros ``$__timeFrom`` and ``$__timeTo``. The macros
become named parameters bound as epoch milliseconds; no value is ever
spliced into SQL text.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import as_double
from ..operators.filters import panel_range

# The macros a panel query may contain.
MACROS = {"$__timeFrom": "time_from", "$__timeTo": "time_to"}


def epoch_millis(t: dt.datetime) -> int:
    """A naive datetime is taken as UTC, like every time in these tables."""
    if t.tzinfo is None:
        t = t.replace(tzinfo=dt.timezone.utc)
    return int(round(t.timestamp() * 1000))


def series(
    df: DataFrame,
    id_col: str,
    value_col: str,
    time_col: str,
    ids: Iterable | None,
    time_from: dt.datetime,
    time_to: dt.datetime,
    alias: str | None = None,
) -> DataFrame:
    """PNL1: ``id``, ``value`` (double), ``time`` for ids in the open range.

    With ``alias`` a constant ``series`` column names the legend entry.
    """
    rows = panel_range(df, id_col, ids, time_col, time_from, time_to)
    cols = [F.col(id_col).alias("id"), as_double(value_col).alias("value"),
            F.col(time_col).alias("time")]
    if alias is not None:
        cols.insert(0, F.lit(alias).alias("series"))
    return rows.select(*cols)


_MACRO = re.compile(r"('(?:[^']|'')*'|\"[^\"]*\"|`[^`]*`)|(" + "|".join(map(re.escape, MACROS)) + r")\b")


def bind_macros(text: str) -> str:
    """Replace each macro with a timestamp built from its bound parameter.

    Quoted text is left alone, and so are longer names that start like a macro.
    """
    return _MACRO.sub(lambda m: m[1] or f"timestamp_millis(:{MACROS[m[2]]})", text)


def panel_sql(spark: SparkSession, text: str, time_from: dt.datetime, time_to: dt.datetime,
              extra_args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """PNL2: run panel SQL with the time range bound as epoch milliseconds.

    ``frames`` name DataFrames that the text uses as ``{name}``; no view of the
    session is created or replaced.
    """
    args = {"time_from": epoch_millis(time_from), "time_to": epoch_millis(time_to)}
    args.update(extra_args or {})
    return spark.sql(bind_macros(text), args=args, **frames)
