"""The reference's streaming jobs and the archiver, wired end to end.

Each function returns the :class:`streaming.jobs.StreamSpec` list of one
application; run it with ``run_together`` (continuous, reference triggers) or
``run_available`` (backfill, tests). Tables live under ``table_root`` and
checkpoints under ``checkpoint_root``, one folder per query; both should be
shared storage (by default under ``spark.checkpoint.dir``).

| application | queries | sink key |
| --- | --- | --- |
| metrics / logs / resources listener | decode -> keyed table (+ rejects) | TABLES[...] |
| views listener | views + transactions per minute, 1 min watermark | timestamp |
| sketch listener | views + transactions per minute with user sketches, for roll-ups | timestamp |
| burst listener | bursts per (user, action, 5 s), 5 s watermark | (user_id, timestamp, count) |
| attackers listener | closed 5 s frames of a user above 50, 5 s watermark | (user_id, timestamp) |
| archiver | day one month ago of logs and metrics -> files | - |
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..functions.decode import rejected, split_decoded, valid
from ..operators.sketches import sketched_transactions, sketched_views
from ..operators.windows import with_watermark
from ..schemas import ATTACKERS, DETECTED, LOGS_WITH_MESSAGE, METRICS, RESOURCES, SKETCH_TABLES, TABLES, TRANSACTION_KINDS
from ..sinks.archive import ArchiveBook, month_ago_date
from ..sinks.keyed import KeyedTable
from ..storage import Files
from ..streaming.attackers import GROUPS, attackers_stream
from ..streaming.jobs import TRIGGERS, StreamSpec
from .telemetry import WIRE_OPTIONS, archive_job, burst_plan, counted, views_and_transactions

_INGEST = {"metrics": METRICS, "logs": LOGS_WITH_MESSAGE, "resources": RESOURCES}


def _table(spark: SparkSession, name: str, table_root: str) -> KeyedTable:
    return KeyedTable(spark, TABLES[name], f"{table_root.rstrip('/')}/{name}")


def listener(spark: SparkSession, name: str, messages: DataFrame, table_root: str,
             checkpoint_root: str, trigger: str | None = "default",
             options: dict[str, str] | None = None) -> list[StreamSpec]:
    """Ingest listener for ``metrics``, ``logs`` or ``resources``.

    One decode per message; valid rows upsert into the table, rejected rows
    (malformed, null message, null key, null event time) go to
    ``{table_root}/_rejected/{name}``. ``options`` default to the wire's time format.
    """
    spec = TABLES[name]
    decoded = split_decoded(messages, _INGEST[name], key=spec.key,
                            options=WIRE_OPTIONS if options is None else options)
    ckpt = f"{checkpoint_root.rstrip('/')}/{name}"
    qname = f"{name}_listener"
    sink = _table(spark, name, table_root).foreach_batch(ckpt, query_name=qname,
                                                         rejects_path=_rejects(table_root, name))
    return [StreamSpec(qname, decoded, ckpt, sink, _trigger(trigger, name))]


def _rejects(table_root: str, name: str) -> str:
    return f"{table_root.rstrip('/')}/_rejected/{name}"


def _trigger(trigger: str | None, name: str) -> str | None:
    return TRIGGERS[name] if trigger == "default" else trigger


def _aside(decoded: DataFrame, name: str, table_root: str, checkpoint_root: str,
           trigger: str | None) -> StreamSpec:
    """A query that keeps the rejected messages of an aggregating job, with status and text."""
    path = _rejects(table_root, name)
    return StreamSpec(f"{name}_rejects", rejected(decoded), f"{checkpoint_root.rstrip('/')}/{name}_rejects",
                      "parquet", trigger, options={"path": path})


def views_listener(spark: SparkSession, messages: DataFrame, table_root: str,
                   checkpoint_root: str, trigger: str | None = "default",
                   kinds: Iterable[str] = TRANSACTION_KINDS, suffix: str = "") -> list[StreamSpec]:
    """AGG1 + AGG2 over one typed stream and the rejects aside, awaited together.

    ``suffix`` keeps query names apart where several run in one session.
    """
    decoded = counted(messages)
    plans = views_and_transactions(with_watermark(valid(decoded), "1 minute"), kinds=kinds)
    specs = [_aside(decoded, "views", table_root, checkpoint_root, _trigger(trigger, "aggregates"))]
    for name, df in plans.items():
        ckpt, qname = f"{checkpoint_root.rstrip('/')}/{name}", f"{name}{suffix}"
        sink = _table(spark, name, table_root).foreach_batch(ckpt, query_name=qname)
        specs.append(StreamSpec(qname, df, ckpt, sink, _trigger(trigger, "aggregates"), rocksdb=True))
    return specs


def sketch_listener(spark: SparkSession, messages: DataFrame, table_root: str,
                    checkpoint_root: str, trigger: str | None = "default",
                    kinds: Iterable[str] = TRANSACTION_KINDS, suffix: str = "") -> list[StreamSpec]:
    """AGG1 + AGG2 with mergeable user sketches (AGG3), and the rejects aside.

    The tables ``views_sketch`` and ``transactions_sketch`` can be rolled up to any multiple of a minute
    (``operators.sketches.roll_up``).
    """
    decoded = counted(messages)
    typed = with_watermark(valid(decoded), "1 minute")
    plans = {"views": sketched_views(typed), "transactions": sketched_transactions(typed, kinds=kinds)}
    specs = [_aside(decoded, "views_sketch", table_root, checkpoint_root, _trigger(trigger, "aggregates"))]
    for name, df in plans.items():
        spec = SKETCH_TABLES[name]
        ckpt, qname = f"{checkpoint_root.rstrip('/')}/{spec.name}", f"{spec.name}{suffix}"
        table = KeyedTable(spark, spec, f"{table_root.rstrip('/')}/{spec.name}")
        specs.append(StreamSpec(qname, df, ckpt, table.foreach_batch(ckpt, query_name=qname),
                                _trigger(trigger, "aggregates"), rocksdb=True))
    return specs


def burst_listener(spark: SparkSession, messages: DataFrame, table_root: str,
                   checkpoint_root: str, trigger: str | None = "default", suffix: str = "") -> list[StreamSpec]:
    """AGG4: bursts per (user, action, 5 s) into the burst table, rejects aside.

    State is one counter per open (user, action, window), kept in RocksDB.
    """
    ckpt, qname = f"{checkpoint_root.rstrip('/')}/metrics_ddos", f"bursts{suffix}"
    decoded = counted(messages)
    sink = _table(spark, "metrics_ddos", table_root).foreach_batch(ckpt, query_name=qname)
    return [_aside(decoded, "metrics_ddos", table_root, checkpoint_root, _trigger(trigger, "ddos")),
            StreamSpec(qname, burst_plan(valid(decoded)), ckpt, sink, _trigger(trigger, "ddos"), rocksdb=True)]


def attackers_listener(spark: SparkSession, messages: DataFrame, table_root: str, checkpoint_root: str,
                       trigger: str | None = "default", frame: str = "5 seconds", threshold: int = 50,
                       delay: str = "5 seconds", suffix: str = "",
                       options: dict[str, str] | None = None, groups: int = GROUPS) -> list[StreamSpec]:
    """WIN2 on the metrics stream: closed frames above the threshold into the attackers table, rejects aside.

    State is one time buffer per user over the frame and the delay, kept in RocksDB by ``groups`` of users
    (see :func:`attackers_stream`). A message without a value is not counted, as in the batch form.
    """
    ckpt, qname = f"{checkpoint_root.rstrip('/')}/attackers", f"attackers{suffix}"
    decoded = split_decoded(messages, DETECTED, key=("user_id",), options=WIRE_OPTIONS if options is None else options)
    table = KeyedTable(spark, ATTACKERS, f"{table_root.rstrip('/')}/attackers")
    found = attackers_stream(valid(decoded), frame, threshold, delay, groups=groups)
    return [_aside(decoded, "attackers", table_root, checkpoint_root, _trigger(trigger, "ddos")),
            StreamSpec(qname, found, ckpt, table.foreach_batch(ckpt, query_name=qname), _trigger(trigger, "ddos"), rocksdb=True)]


def all_tables(spark: SparkSession, table_root: str) -> dict[str, KeyedTable]:
    """Every table of the applications that has been written to under ``table_root``."""
    specs = {**TABLES, **{s.name: s for s in SKETCH_TABLES.values()}, ATTACKERS.name: ATTACKERS}
    present = set(Files(spark).names(table_root))
    return {name: KeyedTable(spark, spec, f"{table_root.rstrip('/')}/{name}") for name, spec in specs.items() if name in present}


def maintain(spark: SparkSession, table_root: str, as_of: dt.datetime, archive_base: str | None = None
             ) -> dict[str, tuple[int, list[dt.date] | str]]:
    """SRT3 + SNK2: compact every table, then purge it where its expired days are proven to be archived.

    Returns each table's generation and the days that left it, or why its purge was refused (its rows stay).
    """
    book = ArchiveBook(spark, archive_base) if archive_base else None
    done: dict[str, tuple[int, list[dt.date] | str]] = {}
    for name, table in all_tables(spark, table_root).items():
        generation = table.compact(as_of)
        try:
            done[name] = generation, table.purge(book=book)
        except ValueError as refused:
            done[name] = generation, str(refused)
    return done


def archiver(spark: SparkSession, table_root: str, as_of: dt.date, out_base: str,
             fmt: str = "csv", tables: tuple[str, ...] = ("logs", "metrics")) -> dict[str, str]:
    """SNK4: the day one month before ``as_of`` of each table, from its live view.

    Rows expired at the start of ``as_of`` are not archived, as the reference's readers no
    longer see them. Compact the tables (``KeyedTable.compact``) to keep the read small.
    """
    day, now = month_ago_date(as_of), dt.datetime.combine(as_of, dt.time())
    views = {name: _table(spark, name, table_root).view(as_of=now, days=(day, day)) for name in tables}
    return archive_job(views, as_of, out_base, fmt)


__all__ = ["all_tables", "archiver", "attackers_listener", "burst_listener", "listener", "maintain", "sketch_listener",
           "views_listener"]
