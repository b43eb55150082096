"""File extracts (SRC3) and saved micro-batches (SRC4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.timefn import TEXT_TIMESTAMP_FORMAT
from ..sinks.text import csv_options, unescape_breaks


def read_csv_extract(
    spark: SparkSession,
    path: str,
    schema: StructType,
    drop: Sequence[str] = ("Unnamed: 0",),
    header: bool = True,
    timestamp_format: str | None = TEXT_TIMESTAMP_FORMAT,
    escaped: bool | None = None,
    index_col: str | None = None,
) -> DataFrame:
    """SRC3: read a CSV extract with a declared schema, drop its index column.

    ``index_col`` names an unnamed first column that holds the row index and is not part
    of ``schema``; the column is dropped if its name is among ``drop``, else kept as a long.

    Time columns are parsed by the schema (no inference pass over the data).
    ``timestamp_format`` defaults to the format this package writes; pass
    None for extracts written elsewhere (e.g. ``yyyy-MM-dd HH:mm:ss`` from
    pandas), which selects Spark's lenient parser (microseconds kept).
    ``escaped`` says that text fields hold escaped line breaks, as this
    package writes them; by default it is so unless ``timestamp_format`` is None.
    """
    opts = csv_options(header=header)
    if timestamp_format is None:
        opts.pop("timestampFormat")
        opts.pop("timestampNTZFormat")
    else:
        opts["timestampFormat"] = opts["timestampNTZFormat"] = timestamp_format
    if index_col is not None:
        schema = StructType([StructField(index_col, LongType()), *schema.fields])
    present = [c for c in drop if c in schema.fieldNames()]
    rows = spark.read.schema(schema).options(**opts).csv(path).drop(*present)
    own = timestamp_format is not None if escaped is None else escaped
    return unescape_breaks(rows) if own else rows


def read_batches(
    spark: SparkSession,
    paths: Sequence[str],
    fmt: str = "parquet",
    schema: StructType | None = None,
) -> DataFrame:
    """SRC4: many saved micro-batches as one table, in one multi-path scan."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(list(paths))
