import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pulsewatch.functions.decode import LOSSLESS_JSON, split_decoded, valid
from pulsewatch.operators.sketches import distinct_of, roll_up, sketched_counts, sketched_views
from pulsewatch.schemas import EVENTS, SKETCH_TABLES
from pulsewatch.sinks.keyed import KeyedTable
from pulsewatch.sinks.publish import publish_segments, segment_stream
from pulsewatch.sources.segments import Topic, lost_segments, read_segments, subscribe_segments
from pulsewatch.streaming.jobs import StreamSpec, run_available
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)


# --- sketches -----------------------------------------------------------------------

def test_merged_sketches_are_near_one_of_all_rows(spark):
    rows = spark.range(20_000).select(
        F.timestamp_seconds(1_704_067_200 + F.col("id") % 7_200).alias("timestamp"), (F.col("id") % 3_000).alias("user_id"))
    minutes = sketched_counts(rows, "1 minute", "n")
    hours = roll_up(minutes, "1 hour", "n", keep_sketch=True)
    direct = sketched_counts(rows, "1 hour", "n")
    a = {r["timestamp"]: (r["n"], r["distinct_users"]) for r in hours.collect()}
    b = {r["timestamp"]: (r["n"], r["d"]) for r in direct.withColumn("d", distinct_of()).collect()}
    assert {t: n for t, (n, _) in a.items()} == {t: n for t, (n, _) in b.items()} and len(a) == 2
    assert all(abs(a[t][1] - b[t][1]) <= 0.05 * b[t][1] for t in a)
    exact = {r["h"]: r["u"] for r in rows.groupBy(F.date_trunc("hour", "timestamp").alias("h"))
             .agg(F.count_distinct("user_id").alias("u")).collect()}
    assert all(abs(a[h][1] - u) <= 0.05 * u for h, u in exact.items())
    day = roll_up(hours, "1 day", "n").collect()
    assert [r["n"] for r in day] == [20_000] and abs(day[0]["distinct_users"] - 3_000) <= 150


def test_sketch_cases(spark):
    schema = "timestamp timestamp, operation_type string, user_id decimal(10,0)"
    rows = spark.createDataFrame([(T0, "VIEW", None), (T0, "VIEW", None), (T0 + dt.timedelta(minutes=2), "VIEW", Decimal(5)),
                                  (T0 + dt.timedelta(minutes=3), "BUY", Decimal(6))], schema)
    minutes = sketched_views(rows)
    got = {r["timestamp"]: (r["views"], r["distinct_users"]) for r in roll_up(minutes, "1 minute", "views").collect()}
    assert got == {T0: (2, 0), T0 + dt.timedelta(minutes=2): (1, 1)}
    assert [(r["views"], r["distinct_users"]) for r in roll_up(minutes, "1 hour", "views").collect()] == [(3, 1)]
    assert roll_up(sketched_views(rows.limit(0)), "1 hour", "views").collect() == []


def test_sketch_table_keeps_the_latest_row(spark, scratch):
    table = KeyedTable(spark, SKETCH_TABLES["views"], f"{scratch}/views")
    rows = spark.createDataFrame([(T0, "VIEW", 1), (T0, "VIEW", 2)], "timestamp timestamp, operation_type string, user_id int")
    table.write_batch(sketched_views(rows.limit(1)), 0, "q", T0)
    table.write_batch(sketched_views(rows), 1, "q", T0)
    out = roll_up(table.view(as_of=T0), "1 day", "views").collect()
    assert [(r["views"], r["distinct_users"]) for r in out] == [(2, 2)]


# --- topics ---------------------------------------------------------------------------

def _events(spark):
    return spark.read.schema(EVENTS).parquet(f"{SF_SMALL}/events.parquet")


def _ids(messages):
    rows = valid(split_decoded(messages, EVENTS, key=("event_id",), time_col="ts", options=LOSSLESS_JSON))
    return sorted(r["event_id"] for r in rows.select("event_id").collect())


def _run(spark, scratch, name="sub", **kw):
    messages = subscribe_segments(spark, f"{scratch}/topic", start_file=f"{scratch}/{name}.start",
                                  loss_path=f"{scratch}/{name}.lost", **kw)
    run_available([StreamSpec(name, messages, f"{scratch}/{name}.ckpt", "parquet",
                              options={"path": f"{scratch}/{name}.out"})])
    return _ids(spark.read.schema("value string").parquet(f"{scratch}/{name}.out"))


def test_segments_hold_whole_writes(spark, scratch):
    ev = _events(spark)
    publish_segments(ev.filter("event_id % 2 = 0").repartition(3), f"{scratch}/topic")
    publish_segments(ev.filter("event_id % 2 = 1"), f"{scratch}/topic")
    publish_segments(ev.limit(0), f"{scratch}/topic")               # nothing to publish: no segment
    topic = Topic(f"{scratch}/topic")
    assert topic.numbers() == [0, 1] and len(topic.manifest(0)["files"]) == 3
    assert topic.manifest(0)["rows"] + topic.manifest(1)["rows"] == ev.count()
    got = read_segments(spark, f"{scratch}/topic")
    assert _ids(got.select("value")) == sorted(r[0] for r in ev.select("event_id").collect())
    assert _ids(got.filter("segment = 1").select("value")) == sorted(r[0] for r in ev.filter("event_id % 2 = 1").select("event_id").collect())
    assert read_segments(spark, f"{scratch}/nothing").collect() == []
    with pytest.raises(Exception, match="line feeds"):
        spark.createDataFrame([("a\nb",)], "value string").write.format("segments").mode("append").save(f"{scratch}/topic")
    assert topic.numbers() == [0, 1]


def test_start_at_latest_or_earliest(spark, scratch):
    ev = _events(spark)
    first, second = ev.filter("event_id < 300"), ev.filter("event_id >= 300")
    publish_segments(first, f"{scratch}/topic")
    assert _run(spark, scratch, "late") == [] and len(_run(spark, scratch, "early", starting_offsets="earliest")) == first.count()
    publish_segments(second, f"{scratch}/topic")
    assert _run(spark, scratch, "late") == sorted(r[0] for r in second.select("event_id").collect())
    assert len(_run(spark, scratch, "early", starting_offsets="earliest")) == ev.count()
    assert _run(spark, scratch, "late") == sorted(r[0] for r in second.select("event_id").collect())   # nothing new


def test_first_offset_survives_a_crash_before_the_first_commit(spark, scratch):
    ev = _events(spark)
    publish_segments(ev.filter("event_id < 300"), f"{scratch}/topic")
    _run(spark, scratch, "one")
    publish_segments(ev.filter("event_id >= 300"), f"{scratch}/topic")
    # A fresh checkpoint with the same start file begins where the first run did.
    os.rename(f"{scratch}/one.ckpt", f"{scratch}/lost.ckpt")
    os.rename(f"{scratch}/one.out", f"{scratch}/lost.out")
    assert _run(spark, scratch, "one") == sorted(r[0] for r in ev.filter("event_id >= 300").select("event_id").collect())


def test_lost_segments(spark, scratch):
    ev = _events(spark)
    for i in range(4):
        publish_segments(ev.filter(f"event_id % 4 = {i}"), f"{scratch}/topic")
    topic = Topic(f"{scratch}/topic")
    topic.drop(1)
    os.unlink(topic.data(topic.manifest(2)["files"][0]))            # the manifest is there, its file is not
    want = sorted(r[0] for r in ev.filter("event_id % 4 in (0, 3)").select("event_id").collect())
    got = _run(spark, scratch, "tolerant", starting_offsets="earliest")
    assert set(want) <= set(got) and not {r[0] for r in ev.filter("event_id % 4 = 1").select("event_id").collect()} & set(got)
    assert [r["segment"] for r in lost_segments(spark, f"{scratch}/tolerant.lost").collect()] == [1, 2]
    with pytest.raises(Exception, match="is gone"):
        _run(spark, scratch, "strict", starting_offsets="earliest", fail_on_data_loss=True)
    with pytest.raises(Exception, match="latest or earliest"):
        _run(spark, scratch, "odd", starting_offsets="middle")


def test_a_replayed_epoch_is_published_once(spark, scratch):
    ev = _events(spark)

    def run():
        messages = subscribe_segments(spark, f"{scratch}/topic", "earliest", start_file=f"{scratch}/start")
        run_available([segment_stream(messages, f"{scratch}/second", f"{scratch}/ckpt", "pub")])

    publish_segments(ev.filter("event_id < 300"), f"{scratch}/topic")
    run()
    publish_segments(ev.filter("event_id >= 300"), f"{scratch}/topic")
    run()
    out = Topic(f"{scratch}/second")
    assert [out.manifest(n)["epoch"] for n in out.numbers()] == [0, 1]
    # The publisher dies after the last epoch's segment is out, before the query has noted it.
    commits = f"{scratch}/ckpt/commits"
    last = max((n for n in os.listdir(commits) if n.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.rename(f"{commits}/{name}", f"{scratch}/{name}.taken")
    run()
    assert [out.manifest(n)["epoch"] for n in out.numbers()] == [0, 1]
    assert _ids(read_segments(spark, f"{scratch}/second", fail_on_data_loss=True).select("value")) \
        == sorted(r[0] for r in ev.select("event_id").collect())
    files = {f for n in out.numbers() for f in out.manifest(n)["files"]}
    assert {f for f in os.listdir(f"{scratch}/second/data") if f.endswith(".txt")} == files


def test_two_producers_never_take_one_number(scratch):
    topic = Topic(scratch)
    assert [topic.publish(["a"], 1, p, e) for p, e in (("x", 0), ("y", 0), ("x", 1))] == [0, 1, 2]
    topic.drop(1)
    assert topic.publish([], 0, "y", 1) == 3
    assert topic.published("x", 1) == 2 and topic.published("y", 0) is None and topic.published("z", 5) is None
    # A number taken meanwhile is passed over.
    topic.end = lambda: 0
    assert topic.publish(["b"], 1, "z", 0) == 1
