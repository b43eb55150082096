"""Time helpers (PRJ7, PRJ9, PRJ10) and lossless text formats.

All of these are native expressions; none needs the driver's clock: the
"as of" instant is always an argument.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats that keep microseconds. Spark's default JSON/CSV
# writers cut timestamps to milliseconds; these do not.
TEXT_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# The reference producer's wire format: zone-less, whole seconds.
WIRE_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 7 * 86_400_000_000,
}
_DURATION = re.compile(r"^\s*(\d+)\s*([a-z]+?)s?\s*$")


def duration_micros(duration: str | int | dt.timedelta) -> int:
    """``"5 seconds"`` / ``timedelta`` / int microseconds -> int microseconds."""
    if isinstance(duration, dt.timedelta):
        return (duration.days * 86_400 + duration.seconds) * 1_000_000 + duration.microseconds
    if isinstance(duration, int):
        return duration
    m = _DURATION.match(duration.lower())
    if not m or m.group(2) not in _UNIT_MICROS:
        raise ValueError(f"unsupported duration: {duration!r}")
    return int(m.group(1)) * _UNIT_MICROS[m.group(2)]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_date(ts: Column | str = "timestamp") -> Column:
    """PRJ7: calendar day of an event time (session zone, pinned to UTC)."""
    return F.to_date(_col(ts))


def month_ago(as_of: dt.date | str | Column) -> Column:
    """PRJ9: ``as_of`` minus one month, clamped to the month's last day.

    2023-03-31 -> 2023-02-28; 2024-02-29 -> 2024-01-29. With a literal
    ``as_of`` the optimizer folds this to a date constant, so a filter
    ``event_date(ts) == month_ago(d)`` still reaches the Parquet scan.
    """
    base = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return F.add_months(base, -1)


def epoch_seconds_to_timestamp(seconds: Column | str) -> Column:
    """PRJ10: epoch seconds (integral or fractional) -> TIMESTAMP."""
    return F.timestamp_seconds(_col(seconds))


def to_micros(ts: Column | str) -> Column:
    """Microseconds since the epoch for TIMESTAMP or TIMESTAMP_NTZ input."""
    return F.unix_micros(_col(ts).cast("timestamp"))
