"""Embedding whitening: distinct integer vectors, their covariance, and its leading directions.

An entry c becomes the integer x = floor(``scale`` * c) + ``origin``. The fit list
holds each distinct integer vector once. Its sums S and covariance V (centred
with S / n before multiplying) are added up per task and combined by Spark, one
row per matrix entry; only matrices of the dimension reach the driver, where
:mod:`.spectrum` finds the leading eigenpairs. Rows are then projected in one
scan of the table.

Vectors are shuffled once, packed into the narrowest of 8, 16, 32 or 64 bits
an entry; copies are combined map-side, so a vector that a third of all rows
share costs a row per task. ``identity_error`` is measured, not derived: the
covariance of the whitened fit list is computed in a further scan of it.

Cases: rows that :mod:`.vectors` does not count are dropped. An empty table gives no
rows. Null and repeated ids are ordinary rows. Directions without variance (rank
below the number of components, or a single distinct vector) cannot be whitened
and give no rows. Integers saturate at 2**40 from ``origin``. ``deviation`` is exact, or null where
it exceeds a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, saved
from .spectrum import leading
from .vectors import dimension, matrix_of

LIMIT = 1 << 40
BATCH_ROWS = 1 << 14


@dataclass(frozen=True)
class Settings:
    components: int = 16
    scale: float = 64.0
    origin: int = 1_000_000


@dataclass(frozen=True)
class Whitening:
    """``sums``: exact sums of x - origin over the ``n`` vectors of the fit list."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    settings: Settings
    identity_error: float = 0.0

    @property
    def size(self) -> int:
        return len(self.sums)

    def centred(self, offsets: np.ndarray) -> np.ndarray:
        """x - S / n of integer offsets x - origin: the whole part is taken off exactly."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (offsets - whole) - rest

    def whitened(self, offsets: np.ndarray) -> np.ndarray:
        return self.centred(offsets) @ self.vectors / np.sqrt(self.values)

    def deviations(self, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sum over dimensions of (n x - S)^2, whether it exceeds a long)."""
        over = ((self.centred(offsets) * self.n) ** 2).sum(axis=1) >= 2.0 ** 63 * (1 - 1e-9)
        # Modulo 2**64 the long arithmetic is exact, so results that fit are right.
        sums = np.array([s % (1 << 64) for s in self.sums], np.uint64)
        turned = offsets.astype(np.uint64) * np.uint64(self.n) - sums
        return (turned * turned).sum(axis=1, dtype=np.uint64).view(np.int64), over


# --- integer vectors, packed ------------------------------------------------------------

def offsets_of(values: np.ndarray, settings: Settings) -> np.ndarray:
    """floor(scale * c): the integers less their origin."""
    return np.clip(np.floor(values * settings.scale), -LIMIT, LIMIT).astype(np.int64)


def pack(offsets: np.ndarray) -> list[bytes]:
    """Each row in its narrowest width; equal rows give equal bytes."""
    out: list[bytes] = [b""] * len(offsets)
    largest = np.maximum(offsets.max(axis=1) + 1, -offsets.min(axis=1))
    done = np.zeros(len(offsets), bool)
    for width in (1, 2, 4, 8):
        rows = np.flatnonzero(~done & (largest <= 1 << (8 * width - 1)))
        raw, step = offsets[rows].astype(f"<i{width}").tobytes(), width * offsets.shape[1]
        for place, row in enumerate(rows.tolist()):
            out[row] = raw[place * step:(place + 1) * step]
        done[rows] = True
    return out


def unpack(column: pa.Array, size: int) -> np.ndarray:
    """The rows of packed vectors; the order of rows is not kept."""
    raw = column.to_pylist()
    parts = []
    for width in (1, 2, 4, 8):
        rows = [r for r in raw if len(r) == width * size]
        if rows:
            parts.append(np.frombuffer(b"".join(rows), f"<i{width}").reshape(-1, size).astype(np.int64))
    return np.concatenate(parts) if parts else np.zeros((0, size), np.int64)


def fit_list(rows: DataFrame, vector: str, size: int, settings: Settings) -> DataFrame:
    """Each distinct integer vector once, packed, in the shared scratch folder."""
    schema = pa.schema([("x", pa.binary())])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_ROWS):
                _, values = matrix_of(batch.column(0).slice(first, BATCH_ROWS), size)
                if len(values):
                    yield batch_of({"x": sorted(set(pack(offsets_of(values, settings))))}, schema)

    return saved(rows.select(vector).mapInArrow(packed, "x binary").distinct(), "whitening-vectors")


# --- sums over the fit list ---------------------------------------------------------------

def _totals(vectors: DataFrame, size: int, part_of, kind: str) -> dict[int, float | int]:
    """Sums by place of ``part_of(rows)`` over all vectors: one row per place and task is shuffled."""
    arrow = pa.int64() if kind == "bigint" else pa.float64()
    schema = pa.schema([("place", pa.int32()), ("total", arrow)])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_ROWS):
                part = part_of(unpack(batch.column(0).slice(first, BATCH_ROWS), size))
                total = part if total is None else total + part
        if total is not None:
            yield batch_of({"place": np.arange(len(total), dtype=np.int32), "total": total}, schema)

    sums = vectors.mapInArrow(summed, f"place int, total {kind}")
    return {r["place"]: r["total"] for r in sums.groupBy("place").agg(F.sum("total").alias("total")).collect()}


def _symmetric(totals: dict[int, float], size: int) -> np.ndarray:
    """A full matrix from the totals of its upper triangle."""
    out = np.zeros((size, size))
    rows, columns = np.triu_indices(size)
    out[rows, columns] = [totals[i] for i in range(len(rows))]
    return out + np.triu(out, 1).T


def fit(rows: DataFrame, vector: str = "embedding", settings: Settings = Settings()) -> Whitening | None:
    """The whitening of ``rows``; None without a usable vector."""
    size = dimension(rows, vector)
    if size is None:
        return None
    vectors = fit_list(rows, vector, size, settings)
    counted = _totals(vectors, size, lambda x: np.append(x.sum(axis=0), len(x)), "bigint")
    n = counted.pop(size)
    empty = Whitening(n, [counted[i] for i in range(size)], np.zeros(0), np.zeros((size, 0)), 0.0, settings)
    upper = np.triu_indices(size)

    def products(x: np.ndarray) -> np.ndarray:
        centred = empty.centred(x)
        return (centred.T @ centred)[upper]

    covariance = _symmetric(_totals(vectors, size, products, "double"), size) / n
    values, directions = leading(covariance, settings.components)
    fitted = Whitening(n, empty.sums, values, directions, float(np.trace(covariance)), settings)
    if not len(values):
        return fitted
    inner = np.triu_indices(len(values))

    def again(x: np.ndarray) -> np.ndarray:
        whitened = fitted.whitened(x)
        return np.append((whitened.T @ whitened)[inner], whitened.sum(axis=0))

    # The mean of the whitened list is zero up to rounding; what is left of it is taken off.
    totals = _totals(vectors, size, again, "double")
    mean = np.array([totals.pop(len(inner[0]) + i) for i in range(len(values))]) / n
    identity = _symmetric(totals, len(values)) / n - np.outer(mean, mean)
    error = float(np.abs(identity - np.eye(len(values))).max())
    return Whitening(n, fitted.sums, values, directions, fitted.trace, settings, error)


# --- projecting ---------------------------------------------------------------------------

def whiten(rows: DataFrame, fitted: Whitening, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable row and component: id, component, n, deviation, whitened, explained, identity_error."""
    shared = rows.sparkSession.sparkContext.broadcast(fitted)
    pairs = rows.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"))
    kind = pairs.schema["vec_id"].dataType.simpleString()
    ddl = (f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, "
           "explained double, identity_error double")

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.values)
        if not k:
            return
        explained = model.values / model.trace
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_ROWS):
                piece = batch.slice(first, BATCH_ROWS)
                at, values = matrix_of(piece.column("vector"), model.size)
                offsets = offsets_of(values, model.settings)
                deviation, over = model.deviations(offsets)
                every = len(at) * k
                yield pa.RecordBatch.from_arrays([
                    piece.column("vec_id").take(pa.array(np.repeat(at, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(every, model.n, np.int64)),
                    pa.array(np.repeat(deviation, k), mask=np.repeat(over, k)),
                    pa.array(model.whitened(offsets).reshape(-1)),
                    pa.array(np.tile(explained, len(at))),
                    pa.array(np.full(every, model.identity_error)),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return pairs.mapInArrow(projected, ddl)


def whitening(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
              settings: Settings = Settings()) -> DataFrame:
    """Fit on ``rows`` and project every usable one of them."""
    narrow = rows.select(vec_id, vector)
    fitted = fit(narrow, vector, settings)
    if fitted is None:
        fitted, narrow = Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, settings), narrow.limit(0)
    return whiten(narrow, fitted, vec_id, vector)
