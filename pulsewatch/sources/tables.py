"""Batch scans of stored tables (SRC2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The driver's tables.
DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """SRC2: scan a stored table; the format and its options are parameters.

    Filters and projections applied later reach the scan (pushed filters,
    pruned read schema) for columnar formats.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in DRIVER_TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_driver_table(spark, sf_dir, "events")
