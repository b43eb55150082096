"""Driver queries on topics: late rows, offsets and lost segments, and publishing from a stream."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.decode import LOSSLESS_JSON, split_decoded, valid
from ..functions.timefn import WIRE_TIMESTAMP_FORMAT
from ..schemas import EVENTS, EVENTS_WIRE, TABLES
from ..session import default_parallelism, scratch_path
from ..sinks.keyed import KeyedTable
from ..sinks.publish import publish_segments, publish_text, segment_stream
from ..sources.segments import Topic, lost_segments, read_segments, subscribe_segments
from ..sources.streams import text_stream
from ..sources.tables import read_events
from ..streaming.attackers import OUTPUT, attackers_stream
from ..streaming.jobs import StreamSpec, caught_up, run_available, running
from ..streaming.late import LateRows
from .applications import burst_listener, listener, views_listener
from .registry import (
    _5S_RANGE, _NATIVE, _TX, BATCH_CUTOFF, NATIVE_FRAME, NATIVE_SPEED, NATIVE_THRESHOLD, STREAM_KINDS, _early, _native,
    _rolling_sql, _wire,
)

# Borders of the segments that the offset query publishes.
SEGMENT_BORDERS = (dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 22))
LOST = 2
# The native clock runs through the data in seven seconds: the delay leaves most of them closed.
ATTACKERS_DELAY = "1 second"
NATIVE_CUTOFF = dt.datetime(1970, 1, 1) + (BATCH_CUTOFF - dt.datetime(1970, 1, 1)) / NATIVE_SPEED


def stream_late(spark, sf_dir):
    """EVT3: the views and burst listeners over the later half of the events, then a restart on the earlier
    half, all of it behind the watermark: what each stateful query dropped, per query."""
    base, ev = scratch_path(spark, "stream_late"), read_events(spark, sf_dir)
    suffix = f"_{base.rsplit('-', 1)[-1]}"

    def run() -> list:
        messages = text_stream(spark, f"{base}/topic")
        specs = [*views_listener(spark, messages, f"{base}/tables", f"{base}/checkpoints", None, STREAM_KINDS, suffix)[1:],
                 *burst_listener(spark, messages, f"{base}/tables", f"{base}/checkpoints", None, suffix)[1:]]
        return run_available([replace(s, state_partitions=default_parallelism(spark)) for s in specs])

    late = LateRows().watch(spark)
    try:
        for part in (~_early(), _early()):
            publish_text(_wire(ev.filter(part)), f"{base}/topic", timestamp_format=WIRE_TIMESTAMP_FORMAT)
            late.settle(run())
    finally:
        late.forget(spark)
    counts = late.frame(spark)
    return counts.select(F.regexp_replace("query", f"{suffix}$", "").alias("query"), "late_rows")


def _segment(number: int) -> Column:
    """Which events the n-th segment of the offset query holds."""
    low = F.col("ts") >= F.lit(SEGMENT_BORDERS[number - 1]) if number else F.lit(True)
    high = F.col("ts") < F.lit(SEGMENT_BORDERS[number]) if number < len(SEGMENT_BORDERS) else F.lit(True)
    return F.coalesce(low & high, F.lit(False))


def _decoded(messages: DataFrame) -> DataFrame:
    return valid(split_decoded(messages, EVENTS, key=("event_id",), time_col="ts", options=LOSSLESS_JSON))


def stream_offsets(spark, sf_dir):
    """SRC1: a subscription that starts at latest (the segment already there is not read), misses a
    segment that is dropped before it is read, and goes on; events by type, and what was lost."""
    base, ev = scratch_path(spark, "stream_offsets"), read_events(spark, sf_dir)
    topic, out = f"{base}/topic", f"{base}/out"

    def run() -> None:
        messages = subscribe_segments(spark, topic, start_file=f"{base}/start/offset.json", loss_path=f"{base}/lost")
        run_available([StreamSpec(f"offsets_{base.rsplit('-', 1)[-1]}", messages, f"{base}/checkpoint", "parquet",
                                  options={"path": out})])

    publish_segments(ev.filter(_segment(0)), topic)
    run()
    for number in range(1, len(SEGMENT_BORDERS) + 1):
        publish_segments(ev.filter(_segment(number)), topic)
    Topic(topic).drop(LOST)
    run()
    lost = lost_segments(spark, f"{base}/lost").count()
    rows = _decoded(spark.read.schema("value string").parquet(out))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.lit(lost).cast("long").alias("lost_segments"))


def stream_published(spark, sf_dir):
    """SNK5: a stream of messages published to a second topic, one segment an epoch, with a
    restart in between; every event is there once."""
    base, ev = scratch_path(spark, "stream_published"), read_events(spark, sf_dir)
    for part in (_early(), ~_early()):
        publish_segments(ev.filter(part), f"{base}/first")
        messages = subscribe_segments(spark, f"{base}/first", "earliest", start_file=f"{base}/start/offset.json")
        run_available([segment_stream(messages, f"{base}/second", f"{base}/checkpoint",
                                      f"publisher_{base.rsplit('-', 1)[-1]}")])
    return _decoded(read_segments(spark, f"{base}/second", fail_on_data_loss=True).select("value"))


def stream_resources(spark, sf_dir):
    """EVT4: the resources listener at its own cadence (every two seconds), fed twice while it runs; a sample that
    is sent again replaces the first."""
    base, ev = scratch_path(spark, "stream_resources"), read_events(spark, sf_dir)
    wire = ev.select(F.col("event_id").cast("string").alias("id"), F.col("ts").alias("timestamp"),
                     F.col("event_type").alias("microservice_id"), F.floor("value").cast("int").alias("cpu"),
                     F.col("user_id").cast("int").alias("ram"))
    again = wire.filter(F.col("microservice_id") == "error").withColumn("cpu", F.col("cpu") + 1000)
    publish_text(wire.filter(F.pmod("ram", F.lit(2)) == 0), f"{base}/topic", timestamp_format=WIRE_TIMESTAMP_FORMAT)
    specs = listener(spark, "resources", text_stream(spark, f"{base}/topic"), f"{base}/tables", f"{base}/checkpoints")
    with running([replace(s, name=f"{s.name}_{base.rsplit('-', 1)[-1]}") for s in specs]) as queries:
        caught_up(queries)
        publish_text(wire.filter(F.pmod("ram", F.lit(2)) == 1), f"{base}/topic", timestamp_format=WIRE_TIMESTAMP_FORMAT)
        caught_up(queries)
        publish_text(again, f"{base}/topic", timestamp_format=WIRE_TIMESTAMP_FORMAT)
        caught_up(queries)
    view = KeyedTable(spark, TABLES["resources"], f"{base}/tables/resources").view(as_of=dt.datetime(2020, 1, 1))
    return view.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def stream_attackers(spark, sf_dir):
    """WIN2 on a stream: the native detector over two runs with a restart in between; the peak of the closed
    frames of every user above the threshold."""
    base, ev = scratch_path(spark, "stream_attackers"), _native(spark, sf_dir)

    def run() -> None:
        typed = valid(split_decoded(text_stream(spark, f"{base}/topic"), EVENTS_WIRE, key=("event_id",), time_col="ts",
                                    options=LOSSLESS_JSON))
        found = attackers_stream(typed, NATIVE_FRAME, NATIVE_THRESHOLD, ATTACKERS_DELAY, "user_id", "ts", "value")
        run_available([StreamSpec(f"attackers_{base.rsplit('-', 1)[-1]}", found, f"{base}/checkpoint", "parquet",
                                  options={"path": f"{base}/found"}, rocksdb=True,
                                  state_partitions=default_parallelism(spark))])

    # On the native clock the cutoff between the batches lies NATIVE_SPEED times nearer to the epoch.
    first = F.coalesce(F.col("ts") < F.lit(NATIVE_CUTOFF), F.lit(False))
    for part in (ev.filter(first), ev.filter(~first)):
        publish_text(part, f"{base}/topic")
        run()
    found = spark.read.schema(OUTPUT).parquet(f"{base}/found")
    return (found.groupBy(F.col("user_id").cast("long").alias("user_id"))
            .agg(F.max("rolling_count").alias("peak_count")))


QUERIES = {"stream_attackers": stream_attackers, "stream_resources": stream_resources, "stream_late": stream_late, "stream_offsets": stream_offsets, "stream_published": stream_published}

_LATE = "SELECT date_trunc('second', ts) AS t, * FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'"
SQL = {
    # Watermarks are whole milliseconds; a frame is closed once the watermark has reached its end.
    "stream_attackers": (
        f"WITH r AS ({_rolling_sql(_5S_RANGE, _NATIVE)}) SELECT user_id, max(rolling_count) AS peak_count FROM r "
        f"WHERE ts <= (SELECT make_timestamp((epoch_us(max(ts)) // 1000 - 1000) * 1000) FROM {_NATIVE}) "
        f"GROUP BY user_id HAVING max(rolling_count) > {NATIVE_THRESHOLD}"
    ),
    "stream_resources": (
        "SELECT CAST(event_id AS VARCHAR) AS id, date_trunc('second', ts) AS \"timestamp\", event_type AS microservice_id, "
        "CAST(floor(value) AS INTEGER) + CASE event_type WHEN 'error' THEN 1000 ELSE 0 END AS cpu, "
        "CAST(user_id AS INTEGER) AS ram FROM events"
    ),
    # A late (group, window) counts once; all windows of the earlier half ended before the watermark.
    "stream_late": f"""
WITH e AS ({_LATE})
SELECT 'views' AS query, count(DISTINCT date_trunc('minute', t)) AS late_rows FROM e WHERE event_type = 'view'
UNION ALL SELECT 'transactions', count(DISTINCT date_trunc('minute', t)) FROM e WHERE event_type IN {_TX}
UNION ALL SELECT 'bursts', count(*) FROM (SELECT DISTINCT user_id, json_extract_string(props, '$.k'),
                                                 time_bucket(INTERVAL '5 seconds', t) FROM e)""",
    "stream_offsets": (
        "SELECT event_type, count(*) AS n, 1::BIGINT AS lost_segments FROM events "
        f"WHERE (ts >= TIMESTAMP '{SEGMENT_BORDERS[0]}' AND ts < TIMESTAMP '{SEGMENT_BORDERS[1]}') "
        f"OR ts >= TIMESTAMP '{SEGMENT_BORDERS[2]}' GROUP BY event_type"
    ),
    "stream_published": "SELECT * FROM events",
}
