"""Day archive and extracts (SNK4, SNK6; PRJ7-9, FLT3).

The archive job copies the rows of one calendar day, one month before the
``as_of`` date, from a stored table to files. The day filter sits on a
derived date, which Spark turns into a pushed range filter on the time
column; no shuffle is involved, and each task writes its own file.

Every archived day leaves a proof next to the archive: the number of its rows and an
order-free checksum (the sum of the rows' 64-bit hashes), taken from the rows as they go
to the writer. :class:`ArchiveBook` reads the files back and compares, so whoever deletes the
archived rows need not trust that the archive is whole.
"""

from __future__ import annotations

import calendar
import datetime as dt
import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.timefn import event_date, month_ago
from ..operators.filters import in_days, on_day
from ..storage import Files
from .text import csv_options, escape_breaks, unescape_breaks


def month_ago_date(as_of: dt.date) -> dt.date:
    """Driver-side twin of :func:`functions.timefn.month_ago`, for path names."""
    year, month = (as_of.year, as_of.month - 1) if as_of.month > 1 else (as_of.year - 1, 12)
    return dt.date(year, month, min(as_of.day, calendar.monthrange(year, month)[1]))


def archive_frame(df: DataFrame, as_of: dt.date | str, time_col: str = "timestamp") -> DataFrame:
    """PRJ7 -> FLT3 -> PRJ8: the rows of the day one month before ``as_of``."""
    return on_day(df, month_ago(as_of), time_col)


# --- proofs ---------------------------------------------------------------------------

def _row_sums(columns: Iterable[str]) -> list[Column]:
    """Rows and the sum of their hashes: equal for equal rows in any order."""
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in columns]).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(hashed), F.lit(0)).cast("string").alias("checksum")]


class ArchiveBook:
    """The proofs of the archives under ``base``: one small file per table and day."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base, self.files = spark, base.rstrip("/"), Files(spark)

    def _file(self, table: str, day: dt.date) -> str:
        return f"{self.base}/_proofs/{table}/{day.isoformat()}.json"

    def record(self, table: str, day: dt.date, path: str, fmt: str, header: bool, schema: StructType,
               rows: int, checksum: str, partitioned: bool = False) -> None:
        self.files.write_json(self._file(table, day), {
            "table": table, "day": day.isoformat(), "path": path, "format": fmt, "header": header,
            "schema": json.loads(schema.json()), "rows": rows, "checksum": checksum, "partitioned": partitioned})

    def proof(self, table: str, day: dt.date) -> dict | None:
        return self.files.read_json(self._file(table, day))

    def _read(self, proofs: list[dict]) -> DataFrame:
        """The rows of archives of one kind, with their day as ``_day``."""
        first = proofs[0]
        schema = StructType.fromJson(first["schema"])
        reader = self.spark.read.format(first["format"]).schema(schema)
        if first["format"] in ("csv", "json"):
            reader = reader.options(**csv_options(header=first["header"]))
        out = None
        for proof in proofs:
            rows = reader.load(f"{proof['path']}/event_date={proof['day']}" if proof["partitioned"] else proof["path"])
            rows = (unescape_breaks(rows) if proof["format"] == "csv" else rows).withColumn("_day", F.lit(proof["day"]))
            out = rows if out is None else out.unionByName(rows)
        return out

    def verify(self, table: str, days: Iterable[dt.date]) -> dict[dt.date, bool]:
        """Which of ``days`` have an archive whose files hold exactly the rows that were archived.

        False without a proof, and where files are missing, cut off, changed or unreadable.
        All days are read in one job; if it fails, each on its own.
        """
        proofs = {day: self.proof(table, day) for day in days}
        known = {day: p for day, p in proofs.items() if p is not None}
        verdict = {day: False for day in proofs}
        try:
            return {**verdict, **self._compare(known)}
        except Exception:  # noqa: BLE001 - any unreadable file: find out which day it is
            for day, proof in known.items():
                try:
                    verdict |= self._compare({day: proof})
                except Exception:  # noqa: BLE001 - unreadable: not proven
                    verdict[day] = False
            return verdict

    def _compare(self, proofs: dict[dt.date, dict]) -> dict[dt.date, bool]:
        kinds: dict[tuple, list[dict]] = {}
        for proof in proofs.values():
            kinds.setdefault((proof["format"], proof["header"], json.dumps(proof["schema"])), []).append(proof)
        found: dict[str, tuple[int, str]] = {}
        for same in kinds.values():
            columns = StructType.fromJson(same[0]["schema"]).names
            found |= {r["_day"]: (r["rows"], r["checksum"]) for r in
                      self._read(same).groupBy("_day").agg(*_row_sums(columns)).collect()}  # one row a day
        return {day: found.get(p["day"], (0, "0")) == (p["rows"], p["checksum"]) for day, p in proofs.items()}


def _writer(df: DataFrame, fmt: str, header: bool):
    if fmt == "csv":
        return escape_breaks(df).write.mode("overwrite").format(fmt).options(**csv_options(header=header))
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "json":
        w = w.options(timestampFormat=csv_options()["timestampFormat"],
                      timestampNTZFormat=csv_options()["timestampNTZFormat"])
    return w


def archive_day(
    df: DataFrame,
    table: str,
    as_of: dt.date,
    base: str,
    fmt: str = "csv",
    header: bool = False,
    time_col: str = "timestamp",
) -> str:
    """SNK4: overwrite ``{base}/{table}_{day}.{fmt}`` with that day's rows.

    Returns the path written. The reference wrote headerless CSV; the format
    is a parameter and the suffix follows it. The day's proof is taken in the same pass.
    """
    day = month_ago_date(as_of)
    path = f"{base.rstrip('/')}/{table}_{day.isoformat()}.{fmt}"
    rows, proof = archive_frame(df, as_of, time_col), Observation()
    _writer(rows.observe(proof, *_row_sums(rows.columns)), fmt, header).save(path)
    ArchiveBook(df.sparkSession, base).record(table, day, path, fmt, header, rows.schema, **proof.get)
    return path


def archive_range(
    df: DataFrame,
    table: str,
    first: dt.date,
    last: dt.date,
    base: str,
    fmt: str = "csv",
    header: bool = False,
    time_col: str = "timestamp",
) -> str:
    """SNK4 catch-up: days ``first..last`` into ``event_date=`` folders.

    Only the days present in the data are replaced (dynamic partition
    overwrite), so a re-run for a gap does not touch other days. Each day gets its
    proof, from one aggregation over the rows of the range (one row a day); days without rows get none.
    """
    path = f"{base.rstrip('/')}/{table}"
    inside = in_days(df, first, last, time_col)
    rows = inside.withColumn("event_date", event_date(time_col))
    sums = rows.groupBy("event_date").agg(*_row_sums(inside.columns)).collect()
    (_writer(rows, fmt, header)
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_date")
     .save(path))
    book = ArchiveBook(df.sparkSession, base)
    for r in sums:
        book.record(table, r["event_date"], path, fmt, header, inside.schema, r["rows"], r["checksum"], partitioned=True)
    return path


def write_extract(df: DataFrame, path: str, mode: str = "overwrite", index_col: str | None = None) -> str:
    """SNK6: a CSV extract with a header, lossless for timestamps, nulls and line breaks.

    ``index_col`` (see ``operators.indexing``) is written as the extract's first column, under
    an empty name: the index column that ``sources.files.read_csv_extract`` reads or drops.
    """
    rows = escape_breaks(df)
    if index_col is not None:
        rows = rows.select(F.col(f"`{index_col}`").alias(""), *[F.col(f"`{c}`") for c in df.columns if c != index_col])
    rows.write.mode(mode).options(**csv_options(header=True)).csv(path)
    return path
