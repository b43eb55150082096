"""Column helpers (PRJ11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(c: Column | str) -> Column:
    """PRJ11: numeric cast used by panel queries."""
    return (F.col(c) if isinstance(c, str) else c).cast("double")
