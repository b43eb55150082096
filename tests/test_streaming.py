import datetime as dt

from pyspark.sql import functions as F

from pulsewatch.functions.decode import split_decoded, valid
from pulsewatch.operators.aggregates import burst_counts
from pulsewatch.operators.windows import with_watermark
from pulsewatch.plans.telemetry import burst_plan as _burst_plan, counted
from pulsewatch.schemas import EVENTS_WIRE, TABLES, events_as_metrics
from pulsewatch.sinks.keyed import KeyedTable
from pulsewatch.sinks.publish import publish_text
from pulsewatch.sources.streams import kafka_options, text_stream
from pulsewatch.streaming.jobs import StreamSpec, run_available, run_together
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)
NOW = dt.datetime(2024, 1, 2)


def burst_plan(messages):
    return _burst_plan(valid(counted(messages)))


def _write_file(spark, path, seconds):
    rows = [(f'{{"id":"e{s}","timestamp":"{(T0 + dt.timedelta(seconds=s)):%Y-%m-%d %H:%M:%S}",'
             f'"action_id":"x","user_id":"u1","value":1}}',) for s in seconds]
    spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").text(path)


def test_late_data_fixture(spark, scratch):
    src, ckpt = f"{scratch}/src", f"{scratch}/ckpt"
    table = KeyedTable(spark, TABLES["metrics_ddos"], f"{scratch}/ddos")
    expected = [
        {},
        {0: 2},
        {0: 2, 5: 2},
        {0: 2, 5: 2, 10: 1, 15: 1},
    ]
    for i, seconds in enumerate([[1, 3, 6], [10], [2, 7, 15], [30]]):
        _write_file(spark, src, seconds)
        plan = burst_plan(text_stream(spark, src))
        run_available([StreamSpec("ddos_late", plan, ckpt, table.foreach_batch(ckpt))])
        got = {(r["timestamp"] - T0).seconds: r["count"] for r in table.view(as_of=NOW).collect()}
        assert got == expected[i], (i, got)


def test_stream_equals_batch_on_closed_windows(spark, scratch):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    publish_text(ev, f"{scratch}/topic")
    typed = events_as_metrics(valid(split_decoded(
        text_stream(spark, f"{scratch}/topic"), EVENTS_WIRE, key=("event_id",), time_col="ts")))
    stream = burst_counts(with_watermark(typed, "1 hour"), "1 hour")
    table = KeyedTable(spark, TABLES["metrics_ddos"].__class__(
        "b", TABLES["metrics_ddos"].schema, ("user_id", "timestamp", "action_id")), f"{scratch}/t")
    ckpt = f"{scratch}/ckpt"
    run_available([StreamSpec("bursts_eq", stream, ckpt, table.foreach_batch(ckpt))])
    # replay: running again on the same checkpoint adds nothing
    run_available([StreamSpec("bursts_eq", stream, ckpt, table.foreach_batch(ckpt))])
    got = table.view(as_of=NOW).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    max_ts = ev.agg(F.max("ts")).first()[0]
    batch = burst_counts(events_as_metrics(ev), "1 hour").filter(
        F.col("timestamp") + F.expr("INTERVAL 1 HOUR") <= F.lit(max_ts) - F.expr("INTERVAL 1 HOUR"))
    assert got.count() == batch.count() > 0
    assert got.exceptAll(batch.select(*got.columns)).count() == 0


def test_run_together_stops_all(spark, scratch):
    src = f"{scratch}/src"
    _write_file(spark, src, [1])
    plan = burst_plan(text_stream(spark, src))
    specs = [StreamSpec(f"tg{i}", plan, f"{scratch}/ck{i}", "noop", trigger="1 second") for i in range(2)]
    queries = run_together(spark, specs, timeout=5)
    assert all(not q.isActive for q in queries)


def test_kafka_options_use_reference_defaults():
    opts = kafka_options("broker:9092", "metrics")
    assert opts == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "metrics",
                    "startingOffsets": "latest", "failOnDataLoss": "false"}


def test_rocksdb_state_store_runs_the_burst_job(spark, scratch):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    src, ckpt = f"{scratch}/src", f"{scratch}/ckpt"
    _write_file(spark, src, [1, 2, 3, 30])
    table = KeyedTable(spark, TABLES["metrics_ddos"], f"{scratch}/ddos")
    q = run_available([StreamSpec("ddos_rocks", burst_plan(text_stream(spark, src)), ckpt,
                                  table.foreach_batch(ckpt), rocksdb=True)])[0]
    assert spark.conf.get(key) == before  # the session's own setting is back
    assert {r["count"] for r in table.view(as_of=NOW).collect()} == {3}
    assert any("rocksdb" in str(o.json).lower() for p in q.recentProgress for o in p.stateOperators)


def test_bad_value_or_missing_id_is_still_counted(spark, scratch):
    from pulsewatch.plans.applications import views_listener

    msgs = ['{"id":"1","timestamp":"2024-01-01 00:00:01","operation_type":"VIEW","user_id":"u","value":1}',
            '{"id":"2","timestamp":"2024-01-01 00:00:02","operation_type":"VIEW","user_id":"u","value":2.7}',
            '{"timestamp":"2024-01-01 00:00:03","operation_type":"VIEW","user_id":"u"}',
            "{broken", '{"id":"4","operation_type":"VIEW","user_id":"u"}',
            '{"id":"9","timestamp":"2024-01-01 00:09:00","operation_type":"VIEW","user_id":"u"}']
    spark.createDataFrame([(m,) for m in msgs], "value string").coalesce(1).write.text(f"{scratch}/topic")
    run_available(views_listener(spark, text_stream(spark, f"{scratch}/topic"), f"{scratch}/t", f"{scratch}/c", None))
    view = KeyedTable(spark, TABLES["views"], f"{scratch}/t/views").view(as_of=NOW)
    assert [(r["timestamp"], r["views"]) for r in view.collect()] == [(T0, 3)]
    aside = spark.read.parquet(f"{scratch}/t/_rejected/views")
    assert sorted(r["status"] for r in aside.collect()) == ["malformed", "missing_time"]
