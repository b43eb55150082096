"""A table laid out for panels: a few ids over a time range (FLT6, PNL1).

A dashboard asks for one id, or a handful, over some days. In a table written as events
arrive every file of those days holds every id, so all of them are read. Here rows are
range-partitioned and sorted by (day, id, time) and written into day folders: an id's rows of a day
are one run, in one file or a few neighbours, and a file's row groups cover narrow id
ranges that min/max statistics tell apart. Where the ids asked for fall inside a row
group's range but not into the group, its Bloom filter on the id says so before any page is read.

A hot id spans as many files as its rows fill; no task holds an id whole.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ..functions.timefn import event_date
from ..operators.filters import panel_range

DAY = "event_date"


def write_series(df: DataFrame, path: str, id_col: str, time_col: str, mode: str = "overwrite",
                 ids_per_group: int = 100_000, block_bytes: int = 128 << 20, partitions: int | None = None) -> str:
    """Write ``df`` for panels over ``id_col``; days present in ``df`` are replaced.

    ``ids_per_group`` sizes the Bloom filters: the distinct ids one row group may hold (at its false positive
    rate of 1 %, about 1.2 bytes each). Rows without an event time go to the null day, which no panel reads.
    """
    dated = df.withColumn(DAY, event_date(time_col))
    keys = [DAY, id_col, time_col]
    laid = dated.repartitionByRange(partitions, *keys) if partitions else dated.repartitionByRange(*keys)
    (laid.sortWithinPartitions(*keys).write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .option(f"parquet.bloom.filter.enabled#{id_col}", "true")
     .option(f"parquet.bloom.filter.expected.ndv#{id_col}", str(ids_per_group))
     .option("parquet.block.size", str(block_bytes))
     .partitionBy(DAY).parquet(path))
    return path


def read_series(spark: SparkSession, path: str, schema: StructType, id_col: str, time_col: str,
                ids: Iterable | None, time_from: dt.datetime, time_to: dt.datetime) -> DataFrame:
    """FLT6 over such a table: folders are pruned by day, row groups by id and time (both bounds open).

    Spark pushes up to ``spark.sql.parquet.pushdown.inFilterThreshold`` ids as a set; beyond, as their range.
    """
    stored = StructType([*schema.fields, StructField(DAY, DateType())])
    rows = spark.read.schema(stored).parquet(path).filter(F.col(DAY).between(F.lit(time_from.date()), F.lit(time_to.date())))
    return panel_range(rows, id_col, ids, time_col, time_from, time_to).drop(DAY)
