"""Driver queries over the given tables: Spark plans and their SQL twins.

Every query reads the driver's ``events`` table in full (no id subsets, no
row caps; a ``limit`` appears only where the top-n is the feature). Mapping
to the reference's vocabulary: operation_type := event_type,
timestamp := ts, action_id := props.k. Where the native 5 s / > 50
settings find nothing on this data, wider frames are used as well
(SURVEY §7.5).

``SQL`` holds, per query key, an equivalent DuckDB query over the same
parquet tables. Column names match one for one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.decode import LOSSLESS_JSON, encode_json, split_decoded, valid
from ..functions.timefn import WIRE_TIMESTAMP_FORMAT, epoch_seconds_to_timestamp
from ..operators import aggregates as agg
from ..operators.filters import labelled
from ..operators.evaluation import confusion, labels_from_flags, report_from_confusion
from ..operators.ordering import newest_first, union_all
from ..operators.pairing import pair_kinds
from ..operators.rolling import attackers, rolling_count
from ..schemas import EVENTS, METRICS, TABLES, TableSpec, action_id, events_as_metrics
from ..session import default_parallelism, scratch_path
from ..sinks.archive import archive_day, archive_range, month_ago_date, write_extract
from ..sinks.keyed import KeyedTable, latest_per_key
from ..sinks.publish import publish_text
from ..sources.files import read_batches, read_csv_extract
from ..sources.streams import text_stream
from ..sources.tables import read_events
from ..streaming.jobs import run_available
from . import panels
from .applications import burst_listener, listener, views_listener

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the driver queries.
VIEW = "view"
TRANSACTION_TYPES = ["view", "purchase", "click"]
STREAM_KINDS = ["VIEW", "PURCHASE", "CLICK"]
DAY_FRAME, DAY_THRESHOLD = "1 day", 7
HOUR_FRAME, HOUR_THRESHOLD = "1 hour", 2
ERROR_TRUTH_MIN = 16
RETENTION_AS_OF = dt.datetime(2024, 2, 10)
RETENTION_TTL = 2_640_000
RETENTION_SPLIT = dt.datetime(2024, 1, 15)
RETENTION_EARLY, RETENTION_LATE = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20)
ARCHIVE_AS_OF = dt.date(2024, 2, 15)
ARCHIVE_FIRST, ARCHIVE_LAST = dt.date(2024, 1, 10), dt.date(2024, 1, 12)
HISTORY_USER = 42
# Four days of the data take a second: the native 5 s and > 50 then find users.
NATIVE_SPEED = 345_600
NATIVE_FRAME, NATIVE_THRESHOLD = "5 seconds", 50
PANEL_USER = 149
PANEL_FROM, PANEL_TO = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20)
PANEL_SQL = (
    "SELECT user_id, count(*) AS n, max(value) AS peak FROM {events} "
    "WHERE ts > $__timeFrom AND ts < $__timeTo GROUP BY user_id"
)
BATCH_CUTOFF = dt.datetime(2024, 1, 15)
UPSERT_FIRST = dt.datetime(2024, 2, 1)
UPSERT_SECOND = dt.datetime(2024, 2, 2)
UPSERT_AS_OF = dt.datetime(2024, 2, 3)

EVENT_COLS = [f.name for f in EVENTS.fields]


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_metrics(read_events(spark, sf_dir))


def _ntz(c: str) -> F.Column:
    return F.col(c).cast("timestamp_ntz").alias(c)


# --- aggregates -------------------------------------------------------------

def views_per_minute(spark, sf_dir):
    return agg.views_per_window(_metrics(spark, sf_dir), "1 minute", view_kind=VIEW, distinct="exact")


def transactions_per_minute(spark, sf_dir):
    return agg.transactions_per_window(_metrics(spark, sf_dir), "1 minute",
                                       kinds=TRANSACTION_TYPES, distinct="exact")


def distinct_users_exact(spark, sf_dir):
    return agg.distinct_by_day(_metrics(spark, sf_dir), "exact")


def distinct_users_bounded(spark, sf_dir):
    return agg.distinct_within_bound(_metrics(spark, sf_dir), rel=0.15)


def burst_counts(spark, sf_dir):
    return agg.burst_counts(_metrics(spark, sf_dir), "1 hour")


# --- rolling counts and the detector ---------------------------------------

def _native(spark, sf_dir: str) -> DataFrame:
    """The events on a clock that runs NATIVE_SPEED times as fast, in whole
    microseconds, so that 5 s frames hold dozens of a user's events."""
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    fast = F.expr(f"(_us - pmod(_us, {NATIVE_SPEED})) div {NATIVE_SPEED}")
    return (read_events(spark, sf_dir).withColumn("_us", micros)
            .withColumn("ts", F.timestamp_micros(fast).cast("timestamp_ntz")).drop("_us"))


def _rolling(source: Callable[[SparkSession, str], DataFrame], frame: str) -> Query:
    def q(spark, sf_dir):
        ev = source(spark, sf_dir).select("event_id", "user_id", "ts", "value")
        return rolling_count(ev, frame, "user_id", "ts", "value").select(
            "event_id", "user_id", "ts", "rolling_count")
    return q


def _attackers(source: Callable[[SparkSession, str], DataFrame], frame: str, threshold: int) -> Query:
    def q(spark, sf_dir):
        ev = source(spark, sf_dir).select("user_id", "ts", "value")
        return attackers(ev, frame, threshold, "user_id", "ts", "value")
    return q


def burst_counts_native(spark, sf_dir):
    return agg.burst_counts(events_as_metrics(_native(spark, sf_dir)), "5 seconds")


def labelled_errors(spark, sf_dir):
    """FLT5: rows that carry a given label (here: events labelled as errors)."""
    ev = read_events(spark, sf_dir).withColumn("attack", (F.col("event_type") == "error").cast("int"))
    return labelled(ev, "attack", 1)


def detector_report(spark, sf_dir):
    ev = read_events(spark, sf_dir)
    # One per-user aggregate gives both the universe and the labelled truth
    # (users with at least ERROR_TRUTH_MIN error events).
    flags = ev.groupBy("user_id").agg(
        (F.count(F.when(F.col("event_type") == "error", 1)) >= ERROR_TRUTH_MIN).alias("y_true"))
    flagged = attackers(ev.select("user_id", "ts", "value"), DAY_FRAME, DAY_THRESHOLD,
                        "user_id", "ts", "value", sort=False)
    return report_from_confusion(confusion(labels_from_flags(flags, flagged, "user_id")))


# --- pairing ------------------------------------------------------------------

def paired_events(spark, sf_dir):
    ev = read_events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type")
    return pair_kinds(ev, "event_type", "view", "click", "user_id", "ts", ["event_id"], "view_", "click_")


# --- decode / encode ------------------------------------------------------------

def json_roundtrip(spark, sf_dir):
    messages = encode_json(read_events(spark, sf_dir))
    return valid(split_decoded(messages, EVENTS, key=("event_id",), time_col="ts",
                               options=LOSSLESS_JSON))


def rejected_rows(spark, sf_dir):
    ev = read_events(spark, sf_dir)
    full = F.to_json(F.struct(*[F.col(c) for c in EVENT_COLS]))
    no_key = F.to_json(F.struct(*[F.col(c) for c in EVENT_COLS if c != "event_id"]))
    no_time = F.to_json(F.struct(*[F.col(c) for c in EVENT_COLS if c != "ts"]))
    text = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("#"), full))
        .when(F.col("event_type") == "signup", no_key)
        .when(F.col("event_type") == "purchase", no_time)
        .otherwise(full)
    )
    decoded = split_decoded(ev.select(text.alias("value")), EVENTS, key=("event_id",), time_col="ts",
                            options=LOSSLESS_JSON)
    return decoded.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def decode_metrics(spark, sf_dir):
    ev = read_events(spark, sf_dir)
    wire = ev.select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").alias("timestamp"),
        F.upper("event_type").alias("operation_type"),
        action_id("props").alias("action_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.floor("value").cast("int").alias("value"),
    )
    messages = encode_json(wire, timestamp_format=WIRE_TIMESTAMP_FORMAT)
    rows = valid(split_decoded(messages, METRICS, options={"timestampFormat": WIRE_TIMESTAMP_FORMAT}))
    return rows.select("id", _ntz("timestamp"), "operation_type", "action_id", "user_id", "value")


def epoch_time(spark, sf_dir):
    ev = read_events(spark, sf_dir)
    secs = F.unix_seconds(F.col("ts").cast("timestamp"))
    return ev.select(
        "event_id",
        secs.alias("epoch_seconds"),
        epoch_seconds_to_timestamp(secs).cast("timestamp_ntz").alias("ts_from_epoch"),
    )


# --- keyed tables, retention, archive ---------------------------------------------

def latest_per_key_q(spark, sf_dir):
    return latest_per_key(read_events(spark, sf_dir), ["user_id", "event_type"], ["ts", "event_id"])


def _events_by_id(ttl_seconds: int | None = None, name: str = "events_by_id") -> TableSpec:
    return TableSpec(name, EVENTS, ("event_id",), ttl_seconds=ttl_seconds, time_column="ts")


def keyed_upsert(spark, sf_dir):
    ev = read_events(spark, sf_dir)
    table = KeyedTable(spark, _events_by_id(), scratch_path(spark, "keyed_upsert"))
    table.write_batch(ev, 0, "q", UPSERT_FIRST)
    corrected = ev.filter(F.col("event_type") == "error").withColumn("value", F.col("value") * 2)
    table.write_batch(corrected, 1, "q", UPSERT_SECOND)
    table.write_batch(ev, 0, "q", UPSERT_FIRST)  # replay: replaces itself
    return table.view()


def compacted_view(spark, sf_dir):
    """SRT3: write, compact and purge, correct some rows with an earlier clock, read."""
    ev = read_events(spark, sf_dir)
    table = KeyedTable(spark, _events_by_id(), scratch_path(spark, "compacted"))
    table.write_batch(ev, 0, "q", UPSERT_SECOND)
    table.compact()
    table.purge()
    corrected = ev.filter(F.col("event_type") == "error").withColumn("value", F.col("value") * 2)
    table.write_batch(corrected, 1, "q", UPSERT_FIRST)  # the batch number decides, not the clock
    return table.view()


def catalog_upsert(spark, sf_dir):
    """SNK3 + SRC2: two writes of one key give one row through the catalog."""
    base = scratch_path(spark, "catalog")
    namespace = f"pulsewatch_{base.rsplit('-', 1)[-1]}"
    table = KeyedTable(spark, _events_by_id(name="events_by_id"), f"{base}/table", namespace)
    ev = read_events(spark, sf_dir)
    try:
        table.ensure()
        table.write_batch(ev, 0, "q", UPSERT_FIRST)
        table.write_batch(ev.filter(F.col("event_type") == "error").withColumn("value", F.col("value") * 2),
                          1, "q", UPSERT_SECOND)
        spark.table(table.refresh()).write.parquet(f"{base}/read")
    finally:
        table.drop()
        spark.sql(f"DROP DATABASE IF EXISTS {namespace}")
    return spark.read.schema(EVENTS).parquet(f"{base}/read")


def _ddos(key: tuple[str, ...]) -> Query:
    def q(spark, sf_dir):
        bursts = agg.burst_counts(_metrics(spark, sf_dir), "1 hour")
        spec = replace(TABLES["metrics_ddos"], schema=bursts.schema, key=key)
        table = KeyedTable(spark, spec, scratch_path(spark, "metrics_ddos"))
        table.write_batch(bursts, 0, "q", UPSERT_FIRST)
        return table.view(as_of=UPSERT_AS_OF)
    return q


def keyed_retention(spark, sf_dir):
    """SNK2: each day's events written on that day; a reader sees those younger than the TTL."""
    ev = read_events(spark, sf_dir)
    table = KeyedTable(spark, _events_by_id(RETENTION_TTL), scratch_path(spark, "retention"))
    early = F.coalesce(F.col("ts") < F.lit(RETENTION_SPLIT), F.lit(False))
    table.write_batch(ev.filter(early), 0, "q", RETENTION_EARLY)
    table.write_batch(ev.filter(~early), 1, "q", RETENTION_LATE)
    return table.view(as_of=RETENTION_AS_OF)


def archive_moved_key(spark, sf_dir):
    """SNK1 -> SNK4: a key re-sent on another day is not in its first day's archive."""
    ev = read_events(spark, sf_dir)
    base = scratch_path(spark, "archive_moved")
    table = KeyedTable(spark, _events_by_id(), f"{base}/table")
    table.write_batch(ev, 0, "q", UPSERT_FIRST)
    moved = ev.filter(F.col("event_type") == "error").withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY"))
    table.write_batch(moved, 1, "q", UPSERT_SECOND)
    day = month_ago_date(ARCHIVE_AS_OF)
    path = archive_day(table.view(days=(day, day)), "events", ARCHIVE_AS_OF, f"{base}/archive", "csv", time_col="ts")
    return read_csv_extract(spark, path, EVENTS, header=False)


def archive_day_q(spark, sf_dir):
    base = scratch_path(spark, "archive")
    path = archive_day(read_events(spark, sf_dir), "events", ARCHIVE_AS_OF, base, "csv", time_col="ts")
    return read_csv_extract(spark, path, EVENTS, header=False)


def archive_table_day(spark, sf_dir):
    """SNK1 -> SNK4: the day one month before ``as_of`` archived from a table keyed by
    (event, time): the key holds the time, so only that day's folders are read."""
    spec = replace(_events_by_id(), key=("event_id", "ts"))
    base = scratch_path(spark, "archive_table")
    table = KeyedTable(spark, spec, f"{base}/table")
    table.write_batch(read_events(spark, sf_dir), 0, "q", UPSERT_FIRST)
    day = month_ago_date(ARCHIVE_AS_OF)
    path = archive_day(table.view(days=(day, day)), "events", ARCHIVE_AS_OF, f"{base}/archive",
                       "csv", time_col="ts")
    return read_csv_extract(spark, path, EVENTS, header=False)


def archive_range_q(spark, sf_dir):
    base = scratch_path(spark, "archive_range")
    path = archive_range(read_events(spark, sf_dir), "events", ARCHIVE_FIRST, ARCHIVE_LAST,
                         base, "parquet", time_col="ts")
    return spark.read.parquet(path).select(*EVENT_COLS, "event_date")


# --- ordering, union, files --------------------------------------------------------

def user_history(spark, sf_dir):
    ev = read_events(spark, sf_dir).filter(F.col("user_id") == HISTORY_USER)
    return newest_first(ev, 10, "ts", "event_id")


def _early() -> F.Column:
    """Batch boundary: rows before the cutoff form the first micro-batch."""
    return F.coalesce(F.col("ts") < F.lit(BATCH_CUTOFF), F.lit(False))


def union_batches(spark, sf_dir):
    ev = read_events(spark, sf_dir)
    return union_all([ev.filter(_early()), ev.filter(~_early())])


def saved_batches(spark, sf_dir):
    ev = read_events(spark, sf_dir)
    base = scratch_path(spark, "batches")
    paths = [f"{base}/batch=0", f"{base}/batch=1"]
    ev.filter(_early()).write.parquet(paths[0])
    ev.filter(~_early()).write.parquet(paths[1])
    return read_batches(spark, paths, schema=EVENTS)


def csv_extract(spark, sf_dir):
    path = write_extract(read_events(spark, sf_dir), scratch_path(spark, "extract"))
    return read_csv_extract(spark, path, EVENTS)


def _noted(spark, sf_dir: str) -> DataFrame:
    """Events with a free text: line breaks, quotes, backslashes, an empty and a null one."""
    note = (F.when(F.col("event_type") == "error", F.concat(F.lit('line 1\nline "2", '), F.col("props"), F.lit("\r\n\\n")))
            .when(F.col("event_type") == "signup", F.lit(""))
            .when(F.col("event_type") == "view", F.lit("\\N"))
            .when(F.col("event_type") == "click", F.lit("a\\\nb")))
    return read_events(spark, sf_dir).select("event_id", "ts", note.alias("note"))


def csv_line_breaks(spark, sf_dir):
    """SNK6 + SNK4 -> SRC3: texts with line breaks, through an extract and an archive."""
    rows, base = _noted(spark, sf_dir), scratch_path(spark, "breaks")
    extract = read_csv_extract(spark, write_extract(rows, f"{base}/extract"), rows.schema)
    path = archive_day(rows, "notes", ARCHIVE_AS_OF, base, "csv", time_col="ts")
    archived = read_csv_extract(spark, path, rows.schema, header=False)
    return union_all([extract.withColumn("source", F.lit("extract")), archived.withColumn("source", F.lit("archive"))])


# --- panels ---------------------------------------------------------------------

def panel_series(spark, sf_dir):
    return panels.series(read_events(spark, sf_dir), "user_id", "value", "ts", [PANEL_USER],
                         PANEL_FROM, PANEL_TO, alias=f"user {PANEL_USER}")


def panel_sql(spark, sf_dir):
    return panels.panel_sql(spark, PANEL_SQL, PANEL_FROM, PANEL_TO, events=read_events(spark, sf_dir))


# --- streaming ------------------------------------------------------------------

def _wire(ev: DataFrame) -> DataFrame:
    """Events as metrics messages; those of some types with a bad value or no id."""
    value = F.when(F.col("event_type") == "click", F.lit("2.7")).otherwise(F.floor("value").cast("string"))
    return ev.select(
        F.when(F.col("event_type") != "signup", F.col("event_id").cast("string")).alias("id"),
        F.col("ts").alias("timestamp"),
        F.upper("event_type").alias("operation_type"),
        action_id("props").alias("action_id"),
        F.col("user_id").cast("string").alias("user_id"),
        value.alias("value"),
    )


def _publish(ev: DataFrame, path: str) -> None:
    """A topic of the events' messages, and one unparsable message per error event."""
    publish_text(_wire(ev), path, timestamp_format=WIRE_TIMESTAMP_FORMAT)
    broken = ev.filter(F.col("event_type") == "error").select(F.concat(F.lit("#"), F.col("event_id")).alias("value"))
    broken.write.mode("append").text(path)


def stream_minutes(spark, sf_dir):
    """The views listener end to end: messages of which some carry a bad value or no
    id (all counted) and some cannot be parsed (kept aside), 1 minute
    watermark, AGG1 + AGG2 into keyed tables; approximate against exact users."""
    base = scratch_path(spark, "stream_minutes")
    ev = read_events(spark, sf_dir)
    _publish(ev, f"{base}/topic")
    run_available([replace(spec, state_partitions=default_parallelism(spark)) for spec in views_listener(
        spark, text_stream(spark, f"{base}/topic"), f"{base}/tables", f"{base}/checkpoints", None,
        STREAM_KINDS, f"_{base.rsplit('-', 1)[-1]}")])
    frames = []
    for name, kinds in (("views", [VIEW]), ("transactions", TRANSACTION_TYPES)):
        exact = (ev.filter(F.col("event_type").isin(kinds)).groupBy(F.date_trunc("minute", "ts").alias("m"))
                 .agg(F.count_distinct("user_id").alias("exact")))
        stored = KeyedTable(spark, TABLES[name], f"{base}/tables/{name}").view(as_of=dt.datetime(2020, 1, 1))
        near = F.abs(F.col("distinct_users") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.15 * F.col("exact"))
        frames.append(stored.withColumn("m", F.col("timestamp").cast("timestamp_ntz"))
                      .join(exact.withColumn("m", F.col("m").cast("timestamp_ntz")), "m")
                      .select(F.lit(name).alias("metric"), F.col("m").alias("timestamp"), F.col(name).alias("n"),
                              near.alias("users_within_bound"), "dummy_id"))
    return union_all(frames)


def stream_rejects(spark, sf_dir):
    """The messages that the views listener set aside, by status."""
    base = scratch_path(spark, "stream_rejects")
    _publish(read_events(spark, sf_dir), f"{base}/topic")
    run_available(views_listener(spark, text_stream(spark, f"{base}/topic"), f"{base}/tables",
                                 f"{base}/checkpoints", None, STREAM_KINDS, f"_{base.rsplit('-', 1)[-1]}")[:1])
    aside = spark.read.parquet(f"{base}/tables/_rejected/views")
    return aside.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def _run_bursts(spark, base: str) -> KeyedTable:
    run_available([replace(spec, state_partitions=default_parallelism(spark)) for spec in burst_listener(
        spark, text_stream(spark, f"{base}/topic"), f"{base}/tables", f"{base}/checkpoints", None,
        f"_{base.rsplit('-', 1)[-1]}")])
    return KeyedTable(spark, TABLES["metrics_ddos"], f"{base}/tables/metrics_ddos")


def _bursts(table: KeyedTable) -> DataFrame:
    rows = table.view(as_of=dt.datetime(2020, 1, 1))
    return rows.select(_ntz("timestamp"), "action_id", "user_id", "count", "dummy_id")


def stream_bursts(spark, sf_dir):
    """The burst listener end to end: wire messages (whole seconds), 5 s watermark,
    5 s windows per (user, action), into the burst table under the
    reference's key (user_id, timestamp, count)."""
    base = scratch_path(spark, "stream_bursts")
    _publish(read_events(spark, sf_dir), f"{base}/topic")
    return _bursts(_run_bursts(spark, base))


def stream_restart(spark, sf_dir):
    """EVT3-5: the burst listener over two published halves, one run on the same checkpoint each, then a
    restart on the first half once more, whose rows are all behind the watermark."""
    base = scratch_path(spark, "stream_restart")
    ev = read_events(spark, sf_dir)
    for part in (_early(), ~_early(), _early()):
        publish_text(_wire(ev.filter(part)), f"{base}/topic", timestamp_format=WIRE_TIMESTAMP_FORMAT)
        table = _run_bursts(spark, base)
    return _bursts(table)


def stream_logs(spark, sf_dir):
    """The reference's log listener end to end: events published as log
    messages (wire format, whole seconds), the error events' messages made
    unparsable, the listener stream decodes each message once, upserts valid
    rows into the logs table (key action_id, id) and sets rejects aside."""
    base = scratch_path(spark, "stream_logs")
    ev = read_events(spark, sf_dir)
    wire = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").alias("timestamp"),
        F.upper("event_type").alias("operation_type"),
        action_id("props").alias("action_id"),
        F.col("user_id").cast("string").alias("user_id"),
    ), {"timestampFormat": WIRE_TIMESTAMP_FORMAT, "timestampNTZFormat": WIRE_TIMESTAMP_FORMAT})
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("#"), wire)).otherwise(wire)
    ev.select(text.alias("value")).write.text(f"{base}/topic")
    specs = listener(spark, "logs", text_stream(spark, f"{base}/topic"), f"{base}/tables",
                     f"{base}/checkpoints", trigger=None)
    run_available(specs)
    view = KeyedTable(spark, TABLES["logs"], f"{base}/tables/logs").view(as_of=dt.datetime(2020, 1, 1))
    return view.select(*[_ntz(c) if c == "timestamp" else F.col(c) for c in view.columns])


QUERIES: dict[str, Query] = {
    "views_per_minute": views_per_minute,
    "transactions_per_minute": transactions_per_minute,
    "distinct_users_exact": distinct_users_exact,
    "distinct_users_bounded": distinct_users_bounded,
    "burst_counts": burst_counts,
    "burst_counts_native": burst_counts_native,
    "rolling_counts": _rolling(read_events, DAY_FRAME),
    "rolling_counts_native": _rolling(_native, NATIVE_FRAME),
    "attackers_day": _attackers(read_events, DAY_FRAME, DAY_THRESHOLD),
    "attackers_hour": _attackers(read_events, HOUR_FRAME, HOUR_THRESHOLD),
    "attackers_native": _attackers(_native, NATIVE_FRAME, NATIVE_THRESHOLD),
    "labelled_errors": labelled_errors,
    "detector_report": detector_report,
    "paired_events": paired_events,
    "json_roundtrip": json_roundtrip,
    "rejected_rows": rejected_rows,
    "decode_metrics": decode_metrics,
    "epoch_time": epoch_time,
    "latest_per_key": latest_per_key_q,
    "keyed_upsert": keyed_upsert,
    "compacted_view": compacted_view,
    "ddos_table": _ddos(("user_id", "timestamp", "count")),
    "ddos_table_by_action": _ddos(("user_id", "timestamp", "count", "action_id")),
    "catalog_upsert": catalog_upsert,
    "keyed_retention": keyed_retention,
    "archive_day": archive_day_q,
    "archive_range": archive_range_q,
    "archive_table_day": archive_table_day,
    "archive_moved_key": archive_moved_key,
    "user_history": user_history,
    "union_batches": union_batches,
    "saved_batches": saved_batches,
    "csv_extract": csv_extract,
    "csv_line_breaks": csv_line_breaks,
    "panel_series": panel_series,
    "panel_sql": panel_sql,
    "stream_minutes": stream_minutes,
    "stream_rejects": stream_rejects,
    "stream_bursts": stream_bursts,
    "stream_restart": stream_restart,
    "stream_logs": stream_logs,
}


# --- DuckDB twins -------------------------------------------------------------------

_DAY_RANGE = "RANGE BETWEEN INTERVAL '86399999999 microseconds' PRECEDING AND CURRENT ROW"
_HOUR_RANGE = "RANGE BETWEEN INTERVAL '3599999999 microseconds' PRECEDING AND CURRENT ROW"
_5S_RANGE = "RANGE BETWEEN INTERVAL '4999999 microseconds' PRECEDING AND CURRENT ROW"


_NATIVE = ("(SELECT event_id, make_timestamp(CAST(floor(epoch_us(ts) / "
           f"{NATIVE_SPEED}.0) AS BIGINT)) AS ts, user_id, event_type, value, props FROM events) AS events")


def _rolling_sql(frame: str, source: str = "events") -> str:
    return (
        "SELECT event_id, user_id, ts, count(value) OVER "
        f"(PARTITION BY user_id ORDER BY ts {frame}) AS rolling_count FROM {source}"
    )


def _attackers_sql(frame: str, threshold: int, source: str = "events") -> str:
    return (
        f"WITH r AS ({_rolling_sql(frame, source)}) "
        "SELECT user_id, max(rolling_count) AS peak_count FROM r GROUP BY user_id "
        f"HAVING max(rolling_count) > {threshold}"
    )


def _burst_sql(bucket: str, source: str = "events") -> str:
    return (
        f"SELECT {bucket} AS \"timestamp\", json_extract_string(props, '$.k') AS action_id, "
        f"user_id, count(*) AS count, '1' AS dummy_id FROM {source} GROUP BY ALL"
    )


_TX = "('view', 'purchase', 'click')"
_HOUR_BURST_SQL = _burst_sql("date_trunc('hour', ts)")

_REPORT_SQL = f"""
WITH users AS (SELECT DISTINCT user_id FROM events),
truth AS (SELECT user_id FROM events WHERE event_type = 'error'
          GROUP BY user_id HAVING count(*) >= {ERROR_TRUTH_MIN}),
pred AS ({_attackers_sql(_DAY_RANGE, DAY_THRESHOLD)}),
lab AS (SELECT u.user_id, t.user_id IS NOT NULL AS yt, p.user_id IS NOT NULL AS yp
        FROM users u LEFT JOIN truth t ON u.user_id = t.user_id
        LEFT JOIN pred p ON u.user_id = p.user_id),
c AS (SELECT sum(CASE WHEN yt AND yp THEN 1 ELSE 0 END)::BIGINT AS tp,
             sum(CASE WHEN NOT yt AND yp THEN 1 ELSE 0 END)::BIGINT AS fp,
             sum(CASE WHEN yt AND NOT yp THEN 1 ELSE 0 END)::BIGINT AS fn,
             sum(CASE WHEN NOT yt AND NOT yp THEN 1 ELSE 0 END)::BIGINT AS tn FROM lab),
m AS (SELECT *,
        CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fp) END AS p1,
        CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp::DOUBLE / (tp + fn) END AS r1,
        CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn::DOUBLE / (tn + fn) END AS p0,
        CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn::DOUBLE / (tn + fp) END AS r0,
        tp + fn AS s1, tn + fp AS s0, tp + fp + fn + tn AS total FROM c),
f AS (SELECT *,
        CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1,
        CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0,
        CASE WHEN total = 0 THEN 0.0 ELSE (tp + tn)::DOUBLE / total END AS acc FROM m)
SELECT '0' AS label, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1_score,
       s0::BIGINT AS support FROM f
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), s1::BIGINT FROM f
UNION ALL SELECT 'accuracy', NULL::DOUBLE, NULL::DOUBLE, round(acc, 6), total::BIGINT FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6),
       round((f0 + f1) / 2, 6), total::BIGINT FROM f
UNION ALL SELECT 'weighted avg',
       round(CASE WHEN total = 0 THEN 0.0 ELSE (p0 * s0 + p1 * s1) / total END, 6),
       round(CASE WHEN total = 0 THEN 0.0 ELSE (r0 * s0 + r1 * s1) / total END, 6),
       round(CASE WHEN total = 0 THEN 0.0 ELSE (f0 * s0 + f1 * s1) / total END, 6),
       total::BIGINT FROM f
"""

_PAIR_SQL = """
WITH v AS (SELECT user_id, event_id, ts,
                  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
           FROM events WHERE event_type = 'view'),
c AS (SELECT user_id, event_id, ts,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
      FROM events WHERE event_type = 'click')
SELECT v.user_id, v.rn, v.event_id AS view_event_id, v.ts AS view_ts,
       c.event_id AS click_event_id, c.ts AS click_ts
FROM v JOIN c ON v.user_id = c.user_id AND v.rn = c.rn
"""

# A filter that does not touch event time is pushed below the watermark, so
# each query's watermark follows the max event time of its own rows.
_STREAM_SQL = f"""
WITH e AS (SELECT date_trunc('second', ts) AS t, event_type FROM events),
v AS (SELECT date_trunc('minute', t) AS m, count(*) AS n FROM e WHERE event_type = 'view' GROUP BY 1),
t AS (SELECT date_trunc('minute', t) AS m, count(*) AS n FROM e WHERE event_type IN {_TX} GROUP BY 1)
SELECT 'views' AS metric, m AS "timestamp", n, true AS users_within_bound, '1' AS dummy_id FROM v
WHERE m + INTERVAL 1 MINUTE <= (SELECT max(t) FROM e WHERE event_type = 'view') - INTERVAL 1 MINUTE
UNION ALL
SELECT 'transactions', m, n, true, '1' FROM t
WHERE m + INTERVAL 1 MINUTE <= (SELECT max(t) FROM e WHERE event_type IN {_TX}) - INTERVAL 1 MINUTE
"""

_NOTES_SQL = r"""
WITH n AS (SELECT event_id, ts, CASE event_type
  WHEN 'error' THEN 'line 1' || chr(10) || 'line "2", ' || props || chr(13) || chr(10) || '\n'
  WHEN 'signup' THEN '' WHEN 'view' THEN '\N' WHEN 'click' THEN 'a\' || chr(10) || 'b' END AS note FROM events)
SELECT *, 'extract' AS source FROM n
UNION ALL SELECT *, 'archive' FROM n WHERE CAST(ts AS DATE) = DATE '2024-01-15'
"""

_STREAM_BURSTS_SQL = """
WITH e AS (SELECT date_trunc('second', ts) AS t, json_extract_string(props, '$.k') AS action_id,
                  CAST(user_id AS VARCHAR) AS user_id FROM events),
b AS (SELECT time_bucket(INTERVAL '5 seconds', t) AS "timestamp", action_id, user_id,
             count(*) AS count, '1' AS dummy_id FROM e GROUP BY 1, 2, 3)
SELECT * FROM b
WHERE "timestamp" + INTERVAL 5 SECOND <= (SELECT max(t) FROM e) - INTERVAL 5 SECOND
QUALIFY row_number() OVER (PARTITION BY user_id, "timestamp", count ORDER BY action_id DESC) = 1
"""

SQL: dict[str, str] = {
    "views_per_minute": (
        "SELECT date_trunc('minute', ts) AS \"timestamp\", count(*) AS views, "
        "count(DISTINCT user_id) AS distinct_users, '1' AS dummy_id "
        "FROM events WHERE event_type = 'view' GROUP BY ALL"
    ),
    "transactions_per_minute": (
        "SELECT date_trunc('minute', ts) AS \"timestamp\", count(*) AS transactions, "
        "count(DISTINCT user_id) AS distinct_users, '1' AS dummy_id "
        f"FROM events WHERE event_type IN {_TX} GROUP BY ALL"
    ),
    "distinct_users_exact": (
        "SELECT CAST(ts AS DATE) AS event_date, count(DISTINCT user_id) AS distinct_users "
        "FROM events GROUP BY ALL"
    ),
    "distinct_users_bounded": (
        "SELECT DISTINCT CAST(ts AS DATE) AS event_date, true AS within_bound FROM events"
    ),
    "burst_counts": _burst_sql("date_trunc('hour', ts)"),
    "burst_counts_native": _burst_sql("time_bucket(INTERVAL '5 seconds', ts)", _NATIVE),
    "rolling_counts": _rolling_sql(_DAY_RANGE),
    "rolling_counts_native": _rolling_sql(_5S_RANGE, _NATIVE),
    "attackers_native": _attackers_sql(_5S_RANGE, NATIVE_THRESHOLD, _NATIVE),
    "labelled_errors": "SELECT *, 1::INTEGER AS attack FROM events WHERE event_type = 'error'",
    "attackers_day": _attackers_sql(_DAY_RANGE, DAY_THRESHOLD),
    "attackers_hour": _attackers_sql(_HOUR_RANGE, HOUR_THRESHOLD),
    "detector_report": _REPORT_SQL,
    "paired_events": _PAIR_SQL,
    "json_roundtrip": "SELECT * FROM events",
    "rejected_rows": (
        "SELECT CASE event_type WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'missing_key' "
        "WHEN 'purchase' THEN 'missing_time' ELSE 'ok' END AS status, count(*) AS n "
        "FROM events GROUP BY ALL"
    ),
    "decode_metrics": (
        "SELECT CAST(event_id AS VARCHAR) AS id, date_trunc('second', ts) AS \"timestamp\", "
        "upper(event_type) AS operation_type, json_extract_string(props, '$.k') AS action_id, "
        "CAST(user_id AS VARCHAR) AS user_id, CAST(floor(value) AS INTEGER) AS value FROM events"
    ),
    "epoch_time": (
        "SELECT event_id, epoch_us(ts) // 1000000 AS epoch_seconds, "
        "make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS ts_from_epoch FROM events"
    ),
    "latest_per_key": (
        "SELECT * FROM events QUALIFY row_number() OVER "
        "(PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"
    ),
    "keyed_upsert": (
        "SELECT event_id, ts, user_id, event_type, "
        "CASE WHEN event_type = 'error' THEN value * 2 ELSE value END AS value, props FROM events"
    ),
    "ddos_table": (
        f"WITH b AS ({_HOUR_BURST_SQL}) SELECT * FROM b QUALIFY "
        "row_number() OVER (PARTITION BY user_id, \"timestamp\", count ORDER BY action_id DESC) = 1"
    ),
    "ddos_table_by_action": _HOUR_BURST_SQL,
    "compacted_view": (
        "SELECT event_id, ts, user_id, event_type, "
        "CASE WHEN event_type = 'error' THEN value * 2 ELSE value END AS value, props FROM events"
    ),
    "keyed_retention": (
        "SELECT * FROM events WHERE CASE WHEN ts < TIMESTAMP '2024-01-15 00:00:00' "
        "THEN TIMESTAMP '2024-01-10 00:00:00' ELSE TIMESTAMP '2024-01-20 00:00:00' END "
        "> TIMESTAMP '2024-02-10 00:00:00' - INTERVAL 2640000 SECOND"
    ),
    "archive_moved_key": (
        "SELECT event_id, t AS ts, user_id, event_type, value, props FROM (SELECT *, "
        "CASE WHEN event_type = 'error' THEN ts + INTERVAL 1 DAY ELSE ts END AS t FROM events) "
        "WHERE CAST(t AS DATE) = DATE '2024-01-15'"
    ),
    "csv_line_breaks": _NOTES_SQL,
    "archive_day": "SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'",
    "archive_table_day": "SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'",
    "archive_range": (
        "SELECT *, CAST(ts AS DATE) AS event_date FROM events "
        "WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'"
    ),
    "user_history": (
        f"SELECT * FROM events WHERE user_id = {HISTORY_USER} "
        "ORDER BY ts DESC, event_id DESC LIMIT 10"
    ),
    "union_batches": "SELECT * FROM events",
    "catalog_upsert": (
        "SELECT event_id, ts, user_id, event_type, "
        "CASE WHEN event_type = 'error' THEN value * 2 ELSE value END AS value, props FROM events"
    ),
    "saved_batches": "SELECT * FROM events",
    "csv_extract": "SELECT * FROM events",
    "panel_series": (
        f"SELECT 'user {PANEL_USER}' AS series, user_id AS id, CAST(value AS DOUBLE) AS value, "
        f"ts AS \"time\" FROM events WHERE user_id IN ({PANEL_USER}) "
        "AND ts > TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'"
    ),
    "panel_sql": (
        "SELECT user_id, count(*) AS n, max(value) AS peak FROM events "
        "WHERE ts > TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00' "
        "GROUP BY user_id"
    ),
    "stream_minutes": _STREAM_SQL,
    "stream_rejects": "SELECT 'malformed' AS status, count(*) AS n FROM events WHERE event_type = 'error' HAVING count(*) > 0",
    "stream_bursts": _STREAM_BURSTS_SQL,
    "stream_restart": _STREAM_BURSTS_SQL,
    "stream_logs": (
        "SELECT CAST(event_id AS VARCHAR) AS id, date_trunc('second', ts) AS \"timestamp\", "
        "CAST(NULL AS VARCHAR) AS level, CAST(NULL AS VARCHAR) AS microservice_id, "
        "upper(event_type) AS operation_type, json_extract_string(props, '$.k') AS action_id, "
        "CAST(user_id AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS message "
        "FROM events WHERE event_type <> 'error'"
    ),
}
