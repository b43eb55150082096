"""Driver queries on stored sketches: hours and days from the minute tables (AGG3)."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sketches import roll_up, sketched_transactions, sketched_views
from ..schemas import SKETCH_TABLES
from ..session import default_parallelism, scratch_path
from ..sinks.keyed import KeyedTable
from ..sources.streams import text_stream
from ..sources.tables import read_events
from ..streaming.jobs import run_available
from .applications import sketch_listener
from .registry import STREAM_KINDS, TRANSACTION_TYPES, UPSERT_AS_OF, UPSERT_FIRST, VIEW, _TX, _metrics, _publish

# Widths of the roll-ups, and the bound of the estimates (over three standard errors).
WIDTHS = (("hour", "1 hour"), ("day", "1 day"))
BOUND = 0.05
_KINDS = (("views", [VIEW]), ("transactions", TRANSACTION_TYPES))


def _near(estimate: str, exact: str):  # noqa: ANN202 - a boolean column
    return F.abs(F.col(estimate) - F.col(exact)) <= F.greatest(F.lit(1.0), BOUND * F.col(exact))


def _compared(minutes: DataFrame, name: str, closed: DataFrame) -> DataFrame:
    """Hours from minutes and days from those hours, against exact counts over ``closed`` events."""
    hours = roll_up(minutes, "1 hour", name, keep_sketch=True)
    days = roll_up(hours, "1 day", name)
    out = None
    for (width, _), rolled in zip(WIDTHS, (hours, days), strict=True):
        exact = (closed.groupBy(F.date_trunc(width, "ts").cast("timestamp_ntz").alias("timestamp"))
                 .agg(F.count_distinct("user_id").alias("exact")))
        rows = (rolled.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")).join(exact, "timestamp")
                .select(F.lit(name).alias("metric"), F.lit(width).alias("width"), "timestamp", F.col(name).alias("n"),
                        _near("distinct_users", "exact").alias("users_within_bound")))
        out = rows if out is None else out.unionByName(rows)
    return out


def distinct_users_rollup(spark, sf_dir):
    """AGG3: minute rows with sketches in keyed tables, rolled up to hours and days; counts
    are exact, estimates compared with the exact distinct users."""
    base, metrics, ev = scratch_path(spark, "rollup"), _metrics(spark, sf_dir), read_events(spark, sf_dir)
    minutes = {"views": sketched_views(metrics, view_kind=VIEW),
               "transactions": sketched_transactions(metrics, kinds=TRANSACTION_TYPES)}
    out = None
    for name, kinds in _KINDS:
        table = KeyedTable(spark, SKETCH_TABLES[name], f"{base}/{name}")
        table.write_batch(minutes[name], 0, "q", UPSERT_FIRST)
        rows = _compared(table.view(as_of=UPSERT_AS_OF), name, ev.filter(F.col("event_type").isin(kinds)))
        out = rows if out is None else out.unionByName(rows)
    return out


def stream_rollup(spark, sf_dir):
    """AGG3 on a stream: the listener keeps sketches per minute; hours and days of the closed minutes."""
    base, ev = scratch_path(spark, "stream_rollup"), read_events(spark, sf_dir)
    _publish(ev, f"{base}/topic")
    run_available([replace(spec, state_partitions=default_parallelism(spark)) for spec in sketch_listener(
        spark, text_stream(spark, f"{base}/topic"), f"{base}/tables", f"{base}/checkpoints", None, STREAM_KINDS,
        f"_{base.rsplit('-', 1)[-1]}")])
    out = None
    for name, kinds in _KINDS:
        minutes = KeyedTable(spark, SKETCH_TABLES[name], f"{base}/tables/{name}_sketch").view(as_of=dt.datetime(2020, 1, 1))
        own = ev.filter(F.col("event_type").isin(kinds)).withColumn("ts", F.date_trunc("second", "ts").cast("timestamp_ntz"))
        last = own.agg(F.max("ts")).first()[0]
        closed = own.filter(F.date_trunc("minute", "ts") + F.expr("INTERVAL 2 MINUTES") <= F.lit(last)) \
            if last is not None else own
        rows = _compared(minutes, name, closed)
        out = rows if out is None else out.unionByName(rows)
    return out


QUERIES = {"distinct_users_rollup": distinct_users_rollup, "stream_rollup": stream_rollup}


def _rollup_sql(closed: bool) -> str:
    parts = []
    for name, kinds in (("views", "('view')"), ("transactions", _TX)):
        rows = f"SELECT date_trunc('second', ts) AS t FROM events WHERE event_type IN {kinds}"
        if closed:
            rows += (" AND date_trunc('minute', ts) + INTERVAL 2 MINUTE <= (SELECT max(date_trunc('second', ts)) "
                     f"FROM events WHERE event_type IN {kinds})")
        for width, _ in WIDTHS:
            parts.append(f"SELECT '{name}' AS metric, '{width}' AS width, date_trunc('{width}', t)::TIMESTAMP AS \"timestamp\", "
                         f"count(*) AS n, true AS users_within_bound FROM ({rows}) GROUP BY ALL")
    return " UNION ALL ".join(parts)


SQL = {"distinct_users_rollup": _rollup_sql(False), "stream_rollup": _rollup_sql(True)}
