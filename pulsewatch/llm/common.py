"""Shared helpers: column guards, scratch tables and vectorised byte hashing.

Text arrives in tasks as Arrow columns. The numpy helpers below work on the
UTF-8 buffer of a few megabytes of rows at a time (:func:`byte_slices`), so a
task's memory is bounded by the slice, or by one document if that is larger.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import read_table

SLICE_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
U64 = np.uint64


# --- DataFrame side ------------------------------------------------------------

def text_or_empty(column: str | Column) -> Column:
    """The text with null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet", "parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation,
    and two readers share one computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, limit: int = BATCH_BYTES) -> Iterator[None]:
    """Jobs started meanwhile send rows to Python in Arrow batches of about ``limit`` bytes (one row if larger).

    By default a batch takes 10,000 whole texts, up to 64 MB; the JVM and the
    worker of each running task hold several copies of it.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(limit))
    try:
        yield
    finally:
        spark.conf.set(key, before)


# --- Arrow side ------------------------------------------------------------------

def utf8_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, nulls as empty texts."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def byte_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of at most ``limit`` bytes (one row if longer).

    Yields (first row, end row, bytes, offsets starting at 0).
    """
    data, offsets = utf8_parts(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(rows, max(end, row + 1))
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def batch_of(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    """A record batch with ``schema`` from arrays or lists by name."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for f, c in
         ((f, columns[f.name]) for f in schema)], schema=schema)


# --- vectorised hashing --------------------------------------------------------------

#: Odd multiplier of the polynomial hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
#: One random 64-bit code per byte value (fixed seed: equal in all tasks).
BYTE_CODES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i < n, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        have = np.ones(size, U64)
        have[1:] = U64(base)
        np.multiply.accumulate(have, out=have)
        if n <= 4 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def prefix_hash(codes: np.ndarray) -> np.ndarray:
    """Running polynomial sums of 64-bit ``codes``; see :func:`span_hash`."""
    sums = np.empty(len(codes) + 1, U64)
    sums[0] = 0
    np.multiply(codes, powers(BASE, len(codes)), out=sums[1:])
    np.cumsum(sums[1:], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Position-independent hash of the spans [start, end)."""
    inverse = powers(BASE_INVERSE, len(sums))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U64))


_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def words(data: np.ndarray, offsets: np.ndarray, skip: np.ndarray | None = None
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each row: maximal runs of bytes that are not white space.

    ``skip``: a 256-entry mask of the separating bytes (default space and
    0x09-0x0D). A word never crosses a row. Returns (start, end, row).
    """
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~(_WHITE if skip is None else skip)[data]
    step = np.diff(inside)
    # A row border inside a run ends one word and starts another.
    border = offsets[1:-1]
    border = border[(border > 0) & (border < len(data))]
    border = np.unique(border)
    split = border[(inside[border] == 1) & (inside[border + 1] == 1)]
    start = np.flatnonzero(step == 1)
    end = np.flatnonzero(step == -1)
    if len(split):
        start = np.sort(np.concatenate([start, split]))
        end = np.sort(np.concatenate([end, split]))
    return start, end, np.searchsorted(offsets, start, "right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each word with A-Z lower-cased."""
    return span_hash(prefix_hash(BYTE_CODES[_LOWER[data]]), start, end)


def ordered_hash(parts: Sequence[np.ndarray], tag: int) -> np.ndarray:
    """Hash of a sequence given column-wise; ``tag`` separates kinds of sequence."""
    total = np.full(len(parts[0]), tag, U64)
    for part in parts:
        total = mix(total * U64(BASE) + part)
    return total
