"""The reference's jobs as plans over message streams or stored tables.

* :func:`counted` - SRC1 -> PRJ1-3 (+ reject split) over the counted fields
* :func:`views_and_transactions` - EVT1 -> AGG1 + AGG2 over one typed stream
* :func:`burst_plan` - EVT1 -> 5 s burst counts (AGG4)
* :func:`archive_job` - SNK4 for several tables, one as-of date
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame

from ..functions.decode import split_decoded
from ..functions.timefn import WIRE_TIMESTAMP_FORMAT
from ..operators.aggregates import burst_counts, transactions_per_window, views_per_window
from ..operators.windows import with_watermark
from ..schemas import COUNTED, TRANSACTION_KINDS
from ..sinks.archive import archive_day

# The producer's time format, pinned: no fallback parser per row.
WIRE_OPTIONS = {"timestampFormat": WIRE_TIMESTAMP_FORMAT}


def counted(messages: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
    """Decoded messages with a status, over the fields that the counts use.

    Only a null or unparsable message and a null event time are rejected;
    no other field can keep a message from being counted.
    """
    return split_decoded(messages, COUNTED, key=(), options=WIRE_OPTIONS if options is None else options)


def views_and_transactions(typed: DataFrame, width: str = "1 minute",
                           kinds: Iterable[str] = TRANSACTION_KINDS,
                           distinct: str | None = "approx",
                           view_kind: str = "VIEW") -> dict[str, DataFrame]:
    """AGG1 and AGG2 over one typed (watermarked) stream."""
    return {
        "views": views_per_window(typed, width, view_kind=view_kind, distinct=distinct),
        "transactions": transactions_per_window(typed, width, kinds, distinct=distinct),
    }


def burst_plan(typed: DataFrame, width: str = "5 seconds", delay: str = "5 seconds") -> DataFrame:
    """AGG4 as the reference's burst job: 5 s watermark and window."""
    return burst_counts(with_watermark(typed.select("timestamp", "action_id", "user_id"), delay), width)


def archive_job(tables: dict[str, DataFrame], as_of: dt.date, base: str,
                fmt: str = "csv") -> dict[str, str]:
    """SNK4 for each table (reference: logs and metrics)."""
    return {name: archive_day(df, name, as_of, base, fmt) for name, df in tables.items()}
