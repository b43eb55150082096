"""Distributed row numbers: one contiguous index over a whole table (SET1, SRT1, JOI1).

A window without a partition key would number a table in one task. Here the rows are
range-partitioned by the order (Spark samples the splitters) and sorted inside each
partition, numbered there by position, and written once to the shared scratch
folder: what is on file fixes both the ranges and the order inside them, so a
lost executor or a retry cannot renumber anything. The rows per partition are then
counted; their prefix sums, one small row per partition, give each
partition its first number, and a scan adds the two.

Cost: one range shuffle, one write and one read of the rows. Rows that tie on the
whole order are told apart by a random last key, so that no group of equals, however
large, has to fit one task; which of such equals comes first is not defined.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..storage import Files

# Spark's monotonically_increasing_id keeps the partition number above this many bits.
POSITION_BITS = 33


def _fresh(df: DataFrame, *names: str) -> list[str]:
    """Helper column names that ``df`` does not use."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def _laid(df: DataFrame, order: Sequence[Column | str], kept: Sequence[str], place: str, ranges: int) -> DataFrame:
    """The rows in ``ranges`` sorted partitions; ``place`` holds partition number and position."""
    (tie,) = _fresh(df, "_tie")
    keys = [F.col(c) if isinstance(c, str) else c for c in order] + [F.col(tie)]
    return (df.withColumn(tie, F.rand(17)).repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
            .select(*kept, F.monotonically_increasing_id().alias(place)))


def row_index(df: DataFrame, order: Sequence[Column | str], out_col: str = "index", start: int = 0,
              partitions: int | None = None) -> DataFrame:
    """``df`` with ``out_col``: start, start + 1, ... in the given order, over all rows.

    Nulls sort as Spark sorts them (first where ascending). An existing column of
    that name is replaced. ``partitions`` is the number of ranges (default: the
    session's shuffle partitions).
    """
    spark = df.sparkSession
    kept = [c for c in df.columns if c.lower() != out_col.lower()]
    place, part_col, first_col = _fresh(df, "_place", "_part", "_first")
    ranges = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = _laid(df, order, kept, place, ranges)
    path = scratch_path(spark, "row-index")
    laid.write.parquet(path)
    rows = spark.read.schema(laid.schema).parquet(path)
    part = F.shiftright(place, POSITION_BITS)
    # One count per range: bounded by ``ranges``, whatever the table's size.
    counts = sorted((r["part"], r["n"]) for r in
                    rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    firsts = accumulate((n for _, n in counts), initial=start)
    offsets = spark.createDataFrame([(p, f) for (p, _), f in zip(counts, firsts, strict=False)],
                                    f"`{part_col}` bigint, `{first_col}` bigint")
    position = F.col(place).bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    return (rows.join(F.broadcast(offsets), part == F.col(part_col))
            .select(*kept, (F.col(first_col) + position).alias(out_col)))


def union_indexed(frames: Iterable[DataFrame], order: Sequence[Column | str], out_col: str = "index",
                  partitions: int | None = None) -> DataFrame:
    """SET1: append batches by column name and renumber the whole from 0.

    Batches keep their sequence; inside a batch rows are numbered in ``order``.
    """
    frames = list(frames)
    (batch,) = _fresh(frames[0], "_batch")
    numbered = [f.withColumn(batch, F.lit(i)) for i, f in enumerate(frames)]
    rows = reduce(lambda a, b: a.unionByName(b), numbered)
    return row_index(rows, [batch, *order], out_col, 0, partitions).drop(batch)


class IndexedBatches:
    """SET1, batch by batch: a table of saved batches whose index runs through all of them.

    Appending numbers the new batch only, from the rows of the batches before it; the
    earlier ones keep their numbers and are not read beyond their row counts (file footers).
    A batch written again replaces itself. Its size must not change once
    a later batch exists, whose numbers would no longer follow on.
    """

    def __init__(self, spark: SparkSession, path: str, out_col: str = "index"):
        self.spark, self.path, self.out_col = spark, path.rstrip("/"), out_col

    def _sizes(self) -> dict[int, int]:
        if not any(n.startswith("batch=") for n in Files(self.spark).names(self.path)):
            return {}
        rows = self.spark.read.option("basePath", self.path).parquet(self.path)
        return {r["batch"]: r["n"] for r in rows.groupBy("batch").agg(F.count(F.lit(1)).alias("n")).collect()}

    def append(self, batch: int, df: DataFrame, order: Sequence[Column | str]) -> int:
        """Write ``df`` as number ``batch`` (ascending); returns the first index it got."""
        sizes = self._sizes()
        start = sum(n for b, n in sizes.items() if b < batch)
        numbered = row_index(df, order, self.out_col, start)
        if any(b > batch for b in sizes) and numbered.count() != sizes.get(batch, 0):
            raise ValueError(f"batch {batch} changed its size after a later batch was numbered")
        numbered.write.mode("overwrite").parquet(f"{self.path}/batch={int(batch)}")
        return start

    def read(self) -> DataFrame:
        """All rows with their index."""
        return self.spark.read.option("basePath", self.path).parquet(self.path).drop("batch")
