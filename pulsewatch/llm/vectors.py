"""Vector columns in Arrow batches: which rows count, and their values.

A row counts if its vector is not null, has the table's dimension and holds
neither nulls nor non-finite entries. The table's dimension is the most
frequent length among such vectors (of equally frequent ones the longest), so
that a stray row of another length does not decide it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str | Column) -> Column:
    """True for a non-empty vector without nulls and non-finite entries."""
    column = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(column, lambda x: F.coalesce(F.abs(x.cast("double")) < F.lit(float("inf")), F.lit(False))
                      & ~F.coalesce(F.isnan(x.cast("double")), F.lit(True)))
    return F.coalesce(finite & (F.size(column) > 0), F.lit(False))


def dimension(df: DataFrame, vector: str) -> int | None:
    """The table's dimension; None without a usable vector."""
    lengths = (df.filter(usable(vector)).groupBy(F.size(vector).alias("length")).count()
               .orderBy(F.desc("count"), F.desc("length")))
    row = lengths.first()
    return row["length"] if row else None


def matrix_of(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, their vectors as doubles) of the rows that count."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == size)
    flat = column.take(pa.array(rows)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    values = flat.reshape(-1, size)
    kept = np.isfinite(values).all(axis=1)
    return rows[kept], values[kept]
