"""Decoding and encoding of JSON messages (PRJ1-3, PRJ12, rejects).

A message stream has one ``value`` column (binary from Kafka, string from
text files). Decoding parses it against a fixed schema in PERMISSIVE mode.
Unlike a plain ``from_json``, :func:`split_decoded` keeps a status for every
row so that malformed text, a null message, a null key or a null event time
is counted and kept with its raw text instead of turning into an all-null row.
Everything here is a native expression: one projection, no Python per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .timefn import TEXT_TIMESTAMP_FORMAT

CORRUPT = "_corrupt_record"

# Statuses a decoded row can get.
REJECT_STATUSES = ["null_value", "malformed", "missing_key", "missing_time"]
OK = "ok"

LOSSLESS_JSON = {
    "timestampFormat": TEXT_TIMESTAMP_FORMAT,
    "timestampNTZFormat": TEXT_TIMESTAMP_FORMAT,
}


def parse_json(value: Column | str, schema: StructType, options: dict | None = None) -> Column:
    """PRJ2: parse by a fixed schema; unknown fields ignored, missing fields null."""
    col = F.col(value) if isinstance(value, str) else value
    return F.from_json(col, schema, options or {})


def decode(
    df: DataFrame,
    schema: StructType,
    value_col: str = "value",
    fields: Sequence[str] | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """PRJ1-3: text -> struct -> flat columns (all fields or the named ones).

    Reference parity: malformed rows become all-null rows. Use
    :func:`split_decoded` to keep them apart instead.
    """
    parsed = df.select(parse_json(F.col(value_col).cast("string"), schema, options).alias("t"))
    names = list(fields) if fields else [f.name for f in schema.fields]
    return parsed.select(*[F.col(f"t.{n}").alias(n) for n in names])


def split_decoded(
    df: DataFrame,
    schema: StructType,
    value_col: str = "value",
    key: Sequence[str] = ("id",),
    time_col: str | None = "timestamp",
    keep: Sequence[str] = (),
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Decode and tag each row with ``status`` ('ok' or one of REJECT_STATUSES).

    Output: the schema's fields, ``status``, ``raw`` (the message text) and
    any ``keep`` columns of the input (e.g. Kafka offsets). Filter with
    :func:`valid` / :func:`rejected`.

    The message is parsed exactly once. Without care the optimizer would push
    a later ``status`` filter below the parse and evaluate ``from_json`` once
    per field reference in the filter and again in the projection; the
    ``inline`` generator between parse and status is a barrier to that.
    ``options`` may pin ``timestampFormat`` when the producer's format is
    known, which skips the fallback parser.
    """
    with_corrupt = StructType(schema.fields + [StructField(CORRUPT, StringType(), True)])
    text = F.col(value_col).cast("string")
    opts = {"columnNameOfCorruptRecord": CORRUPT, **(options or {})}
    parsed = df.select(
        *[F.col(k) for k in keep],
        text.alias("raw"),
        parse_json(text, with_corrupt, opts).alias("t"),
    )
    key_null = F.lit(False)
    for k in key:
        key_null = key_null | F.col(f"t.{k}").isNull()
    status = (
        F.when(F.col("raw").isNull(), "null_value")
        .when(F.col(f"t.{CORRUPT}").isNotNull() | F.col("t").isNull(), "malformed")
        .when(key_null, "missing_key")
    )
    if time_col:
        status = status.when(F.col(f"t.{time_col}").isNull(), "missing_time")
    status = status.otherwise(OK)
    row = F.struct(
        *[F.col(f"t.{f.name}").alias(f.name) for f in schema.fields],
        status.alias("status"),
        F.col("raw"),
        *[F.col(k) for k in keep],
    )
    return parsed.select(F.inline(F.array(row)))


def valid(decoded: DataFrame) -> DataFrame:
    """Rows of :func:`split_decoded` that passed, without the bookkeeping columns."""
    return decoded.filter(F.col("status") == OK).drop("status", "raw")


def rejected(decoded: DataFrame) -> DataFrame:
    """Rows of :func:`split_decoded` that failed, with status and raw text."""
    return decoded.filter(F.col("status") != OK)


def encode_json(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    alias: str = "value",
    timestamp_format: str = TEXT_TIMESTAMP_FORMAT,
) -> DataFrame:
    """PRJ12: record -> JSON text, one ``value`` column.

    Timestamps keep microseconds by default; pass the wire format
    ``yyyy-MM-dd HH:mm:ss`` to reproduce the reference producer exactly.
    """
    cols = [F.col(c) for c in columns] if columns else [F.col(c) for c in df.columns]
    opts = {"timestampFormat": timestamp_format, "timestampNTZFormat": timestamp_format}
    return df.select(F.to_json(F.struct(*cols), opts).alias(alias))
