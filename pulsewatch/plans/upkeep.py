"""Driver queries on table upkeep: compaction by day, purge by manifest, proven archives, panel layout."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from ..functions.columns import as_double
from ..schemas import EVENTS
from ..session import scratch_path
from ..sinks.archive import ArchiveBook, archive_range
from ..sinks.keyed import KeyedTable
from ..sinks.series import read_series, write_series
from ..sinks.text import csv_options
from ..sources.tables import read_events
from .registry import (
    PANEL_FROM, PANEL_TO, RETENTION_AS_OF, RETENTION_EARLY, RETENTION_LATE, RETENTION_SPLIT, RETENTION_TTL, UPSERT_FIRST,
    UPSERT_SECOND, _events_by_id,
)

# The users of the panel query, and the days that the second batch of the compaction query corrects.
PANEL_IDS = (3, 7, 11)
CORRECTED = (dt.date(2024, 1, 10), dt.date(2024, 1, 12))


def compacted_days(spark, sf_dir):
    """SRT3 + SNK1: compact, correct some days, compact again (only those days are rewritten), purge, read."""
    ev = read_events(spark, sf_dir)
    spec = replace(_events_by_id(), key=("event_id", "ts"))
    table = KeyedTable(spark, spec, scratch_path(spark, "compacted_days"))
    table.write_batch(ev, 0, "q", UPSERT_FIRST)
    table.compact()
    first, last = CORRECTED
    some = ev.filter(F.to_date("ts").between(F.lit(first), F.lit(last))).withColumn("value", F.col("value") * 2)
    table.write_batch(some, 1, "q", UPSERT_SECOND)
    table.compact()
    table.purge()
    return table.view()


def archive_verified(spark, sf_dir):
    """SNK4 + SNK2: the days that expire are archived, the archive is proven, and only then purged; per
    day the archived rows, whether they were proven, and how many the table still holds."""
    base, ev = scratch_path(spark, "archive_verified"), read_events(spark, sf_dir)
    table = KeyedTable(spark, _events_by_id(RETENTION_TTL, "events"), f"{base}/table")
    early = F.coalesce(F.col("ts") < F.lit(RETENTION_SPLIT), F.lit(False))
    table.write_batch(ev.filter(early), 0, "q", RETENTION_EARLY)
    table.write_batch(ev.filter(~early), 1, "q", RETENTION_LATE)
    bounds = ev.agg(F.min(F.to_date("ts")).alias("a"), F.max(F.to_date("ts")).alias("z")).first()
    if bounds["a"] is not None:
        archive_range(table.view(as_of=RETENTION_LATE), "events", bounds["a"], bounds["z"], base, "csv", time_col="ts")
    table.compact(RETENTION_AS_OF)
    book = ArchiveBook(spark, base)
    expired = table.purge(book=book)
    proven = spark.createDataFrame([(d, p) for d, p in book.verify("events", expired).items()],
                                   "event_date date, proven boolean")
    archived = (spark.read.schema(StructType([*EVENTS.fields, StructField("event_date", DateType())])).options(**csv_options(header=False))
                .csv(f"{base}/events").groupBy("event_date").agg(F.count("event_id").alias("archived")))
    left = table.stored_rows().groupBy("event_date").agg(F.count(F.lit(1)).alias("left"))
    return (archived.join(proven, "event_date").join(left, "event_date", "left")
            .select("event_date", "archived", "proven", F.coalesce("left", F.lit(0)).cast("long").alias("left_rows")))


def panel_ids(spark, sf_dir):
    """FLT6 + PNL1: a panel of some users over some days, from a table laid out by day, user and time."""
    path = write_series(read_events(spark, sf_dir), scratch_path(spark, "panel_ids"), "user_id", "ts")
    rows = read_series(spark, path, EVENTS, "user_id", "ts", PANEL_IDS, PANEL_FROM, PANEL_TO)
    return rows.select(F.col("user_id").alias("id"), as_double("value").alias("value"), F.col("ts").alias("time"))


QUERIES = {"panel_ids": panel_ids, "compacted_days": compacted_days, "archive_verified": archive_verified}

SQL = {
    "panel_ids": (
        f"SELECT user_id AS id, CAST(value AS DOUBLE) AS value, ts AS \"time\" FROM events WHERE user_id IN {PANEL_IDS} "
        f"AND ts > TIMESTAMP '{PANEL_FROM}' AND ts < TIMESTAMP '{PANEL_TO}'"
    ),
    "compacted_days": (
        "SELECT event_id, ts, user_id, event_type, "
        f"CASE WHEN CAST(ts AS DATE) BETWEEN DATE '{CORRECTED[0]}' AND DATE '{CORRECTED[1]}' THEN value * 2 ELSE value END "
        "AS value, props FROM events"
    ),
    "archive_verified": (
        "SELECT CAST(ts AS DATE) AS event_date, count(*) AS archived, true AS proven, 0::BIGINT AS left_rows FROM events "
        f"WHERE ts < TIMESTAMP '{RETENTION_SPLIT}' GROUP BY ALL"
    ),
}
