import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pulsewatch.functions.timefn import month_ago
from pulsewatch.schemas import BURSTS, TABLES, TableSpec
from pulsewatch.sinks.archive import archive_day, archive_frame, month_ago_date, write_extract
from pulsewatch.sinks.keyed import KeyedTable, retained
from pulsewatch.sources.files import read_csv_extract
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

SPEC = TableSpec(
    "kv",
    StructType([StructField("k", StringType()), StructField("timestamp", TimestampType()),
                StructField("v", LongType())]),
    ("k",),
    ttl_seconds=None,
)
KEPT = replace(SPEC, ttl_seconds=2_640_000)
DATED = replace(SPEC, key=("k", "timestamp"))
T0 = dt.datetime(2024, 1, 1)
W1, W2 = dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)


def _kv(spark, rows):
    return spark.createDataFrame([(k, T0, v) for k, v in rows], "k string, timestamp timestamp, v long")


def _view(table, **kw):
    return {r["k"]: r["v"] for r in table.view(**kw).collect()}


def test_upsert_across_batches_and_replay(spark, scratch):
    t = KeyedTable(spark, SPEC, scratch)
    t.write_batch(_kv(spark, [("a", 1), ("b", 1)]), 0, "q", W1)
    t.write_batch(_kv(spark, [("a", 2)]), 1, "q", W2)
    assert _view(t) == {"a": 2, "b": 1}
    t.write_batch(_kv(spark, [("a", 1), ("b", 1)]), 0, "q", W1)  # replay
    assert _view(t) == {"a": 2, "b": 1}
    assert t.log().count() == 3


def test_same_key_twice_in_one_batch_is_deterministic(spark, scratch):
    t = KeyedTable(spark, SPEC, scratch)
    t.write_batch(_kv(spark, [("a", 1), ("a", 7)]), 0, "q", W1)
    assert _view(t) == {"a": 7}  # ties broken by the remaining columns


def test_null_key_is_kept_aside(spark, scratch):
    t = KeyedTable(spark, SPEC, scratch)
    t.write_batch(_kv(spark, [(None, 1), ("a", 2)]), 0, "q", W1)
    assert _view(t) == {"a": 2}
    assert [r["v"] for r in t.rejected().collect()] == [1]


def test_batch_number_decides_within_a_query(spark, scratch):
    t = KeyedTable(spark, SPEC, scratch)
    t.write_batch(_kv(spark, [("a", 1)]), 5, "q", W2)
    t.write_batch(_kv(spark, [("a", 2)]), 6, "q", W1)  # the clock stepped back
    assert _view(t) == {"a": 2}


def test_write_time_decides_between_queries(spark, scratch):
    t = KeyedTable(spark, SPEC, scratch)
    t.write_batch(_kv(spark, [("a", 1)]), 9, "old", W1)
    t.write_batch(_kv(spark, [("a", 2)]), 0, "new", W2)
    assert _view(t) == {"a": 2}


def test_empty_table_has_no_rows(spark, scratch):
    t = KeyedTable(spark, SPEC, scratch)
    assert t.view().count() == 0 and t.rejected().count() == 0 and t.purge() == []
    t.write_batch(_kv(spark, [(None, 1)]), 0, "q", W1)  # all rejected
    assert t.view().count() == 0


def test_fresh_checkpoint_does_not_overwrite(spark, scratch):
    t = KeyedTable(spark, SPEC, scratch)
    t.write_batch(_kv(spark, [("a", 1)]), 0, "run1", W1)
    t.write_batch(_kv(spark, [("b", 1)]), 0, "run2", W2)
    assert _view(t) == {"a": 1, "b": 1}


def test_burst_key_collapses_equal_counts(spark, scratch):
    rows = [(T0, "x", "u1", 3, "1"), (T0, "y", "u1", 3, "1")]
    df = spark.createDataFrame(rows, BURSTS)
    ref = KeyedTable(spark, TABLES["metrics_ddos"], scratch + "/ref")
    ref.write_batch(df, 0, "q", W1)
    assert ref.view(as_of=W2).count() == 1
    wide_spec = TableSpec("bursts", BURSTS, ("user_id", "timestamp", "count", "action_id"))
    wide = KeyedTable(spark, wide_spec, scratch + "/wide")
    wide.write_batch(df, 0, "q", W1)
    assert wide.view(as_of=W2).count() == 2


def test_retention_bounds(spark):
    as_of = dt.datetime(2024, 2, 10)
    ttl = 2_640_000
    edge = as_of - dt.timedelta(seconds=ttl)
    rows = [("exact", edge), ("inside", edge + dt.timedelta(seconds=1)),
            ("outside", edge - dt.timedelta(seconds=1))]
    df = spark.createDataFrame(rows, "k string, write_time timestamp")
    assert sorted(r["k"] for r in retained(df, as_of, ttl).collect()) == ["inside"]


def test_view_applies_ttl_and_needs_as_of(spark, scratch):
    t = KeyedTable(spark, KEPT, scratch + "/t")
    t.write_batch(_kv(spark, [("old", 1)]), 0, "q", dt.datetime(2023, 1, 1))
    t.write_batch(_kv(spark, [("new", 1)]), 1, "q", W2)
    assert _view(t, as_of=dt.datetime(2024, 1, 10)) == {"new": 1}
    with pytest.raises(ValueError):
        t.view()


def test_compaction_feeds_back_and_purge_needs_archived_days(spark, scratch):
    t = KeyedTable(spark, KEPT, scratch + "/t")
    now = dt.datetime(2024, 1, 10)
    t.write_batch(_kv(spark, [("old", 1)]), 0, "q", dt.datetime(2023, 1, 1))
    t.write_batch(_kv(spark, [("a", 1), ("b", 1)]), 1, "q", W1)
    assert t.compact(now) == 1
    assert _view(t, as_of=now) == {"a": 1, "b": 1}
    with pytest.raises(ValueError, match="not archived"):
        t.purge()
    assert t.purge([T0.date()]) == [T0.date()]
    assert t.log().count() == 0 and _view(t, as_of=now) == {"a": 1, "b": 1}
    t.write_batch(_kv(spark, [("a", 2)]), 2, "q", W1)
    t.write_batch(_kv(spark, [("b", 9)]), 1, "q", W1)  # a replay of a compacted batch changes nothing
    assert _view(t, as_of=now) == {"a": 2, "b": 1}
    assert t.compact(now) == 2
    t.purge([T0.date()])
    assert _view(t, as_of=now) == {"a": 2, "b": 1}
    # expiry still works on compacted rows: they keep their write time
    assert _view(t, as_of=W1 + dt.timedelta(seconds=KEPT.ttl_seconds)) == {}


def test_catalog_shows_one_row_per_key(spark, scratch):
    t = KeyedTable(spark, SPEC, scratch, namespace="pw_test")
    name = t.ensure()
    assert t.ensure() == name
    try:
        t.write_batch(_kv(spark, [("a", 1), ("b", 1)]), 0, "q", W1)
        t.write_batch(_kv(spark, [("a", 2)]), 1, "q", W2)
        assert {r["k"]: r["v"] for r in spark.table(t.refresh()).collect()} == {"a": 2, "b": 1}
        assert spark.table(f"{name}_log").count() == 3
        t.compact()
        t.write_batch(_kv(spark, [("b", 5)]), 2, "q", W2)
        assert {r["k"]: r["v"] for r in spark.table(t.refresh()).collect()} == {"a": 2, "b": 5}
    finally:
        t.drop()
        spark.sql("DROP DATABASE pw_test")


def test_month_clamp(spark):
    cases = {
        dt.date(2023, 3, 31): dt.date(2023, 2, 28),
        dt.date(2024, 2, 29): dt.date(2024, 1, 29),
        dt.date(2023, 3, 28): dt.date(2023, 2, 28),
        dt.date(2023, 3, 29): dt.date(2023, 2, 28),
        dt.date(2024, 1, 15): dt.date(2023, 12, 15),
    }
    row = spark.range(1).select(*[month_ago(d).alias(str(i)) for i, d in enumerate(cases)]).first()
    assert list(row) == list(cases.values())
    assert [month_ago_date(d) for d in cases] == list(cases.values())


def test_archive_filter_reaches_the_scan(spark):
    from tests.conftest import SF_SMALL

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    plan = archive_frame(ev, dt.date(2024, 2, 15), "ts")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in plan, plan


def test_archive_day_round_trip(spark, scratch):
    from tests.conftest import SF_SMALL
    from pulsewatch.schemas import EVENTS

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    path = archive_day(ev, "events", dt.date(2024, 2, 15), scratch, time_col="ts")
    assert path.endswith("/events_2024-01-15.csv")
    back = read_csv_extract(spark, path, EVENTS, header=False)
    want = ev.filter(F.to_date("ts") == F.lit("2024-01-15").cast("date"))
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0


def test_text_round_trip_is_lossless(spark, scratch):
    schema = "id long, ts timestamp, message string"
    rows = [(1, dt.datetime(2024, 1, 1, 0, 0, 0, 123456), ""),
            (2, dt.datetime(2024, 1, 1, 0, 0, 1, 1), None),
            (3, dt.datetime(2024, 1, 1), 'a "quoted", comma\nand newline'),
            (4, dt.datetime(2024, 1, 1), "\\n \\\n \r\n \\\\r"), (5, dt.datetime(2024, 1, 1), "\\N")]
    df = spark.createDataFrame(rows, schema)
    path = write_extract(df, scratch + "/x")
    back = read_csv_extract(spark, path, df.schema)
    assert sorted(tuple(r) for r in back.collect()) == rows


def test_query_id_from_checkpoint_metadata(spark, scratch):
    """Without a query name the sink reads the id kept in the checkpoint."""
    from pulsewatch.sources.streams import text_stream
    from pulsewatch.streaming.jobs import StreamSpec, run_available

    spark.createDataFrame([('{"k":"a","timestamp":"2024-01-01 00:00:00","v":1}',)], "value string") \
        .write.text(scratch + "/src")
    from pulsewatch.functions.decode import split_decoded, valid
    rows = valid(split_decoded(text_stream(spark, scratch + "/src"), SPEC.schema, key=("k",)))
    t = KeyedTable(spark, SPEC, scratch + "/t")
    ckpt = scratch + "/ck"
    q = run_available([StreamSpec("qid_test", rows, ckpt, t.foreach_batch(ckpt))])[0]
    ids = {r["query_id"] for r in t.log().select("query_id").collect()}
    assert ids == {q.id}


def test_view_of_days_prunes_partitions(spark, scratch):
    t = KeyedTable(spark, DATED, scratch + "/t")
    rows = [(f"k{d}", dt.datetime(2024, 1, d, 12), d) for d in (1, 2, 3)]
    t.write_batch(spark.createDataFrame(rows, "k string, timestamp timestamp, v long"), 0, "q", W1)
    v = t.view(days=(dt.date(2024, 1, 2), dt.date(2024, 1, 2)))
    assert {r["k"] for r in v.collect()} == {"k2"}
    plan = v._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan, plan


def test_view_of_days_without_time_in_the_key_filters_after_latest(spark, scratch):
    t = KeyedTable(spark, SPEC, scratch + "/t")
    first = spark.createDataFrame([("a", dt.datetime(2024, 1, 2), 1)], "k string, timestamp timestamp, v long")
    moved = spark.createDataFrame([("a", dt.datetime(2024, 1, 3), 2)], "k string, timestamp timestamp, v long")
    t.write_batch(first, 0, "q", W1)
    t.write_batch(moved, 1, "q", W2)
    # The latest row of "a" is on Jan 3, so a view of Jan 2 is empty.
    assert t.view(days=(dt.date(2024, 1, 2), dt.date(2024, 1, 2))).count() == 0


def test_reads_a_pandas_extract_and_drops_its_index(spark, scratch):
    """SRC3: a CSV written with an index column (empty header) and text times."""
    import os

    import pandas as pd

    os.makedirs(scratch, exist_ok=True)
    path = f"{scratch}/metrics.csv"
    pd.DataFrame({
        "timestamp": ["2024-01-01 00:00:01", "2024-01-01 00:00:02"],
        "user_id": ["u1", "u2"],
        "value": [0, 1],
    }).to_csv(path)
    schema = StructType([
        StructField("Unnamed: 0", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("user_id", StringType()),
        StructField("value", LongType()),
    ])
    df = read_csv_extract(spark, path, schema, timestamp_format=None)
    assert df.columns == ["timestamp", "user_id", "value"]
    assert [tuple(r) for r in df.orderBy("timestamp").collect()] == [
        (dt.datetime(2024, 1, 1, 0, 0, 1), "u1", 0), (dt.datetime(2024, 1, 1, 0, 0, 2), "u2", 1)]


def test_clustered_layout_splits_a_hot_key(spark):
    from pulsewatch.operators.ordering import clustered

    rows = [("hot", T0 + dt.timedelta(seconds=i), i % 7) for i in range(400)]
    rows += [(f"u{i}", T0, 1) for i in range(20)]
    df = spark.createDataFrame(rows, "user_id string, timestamp timestamp, count long")
    out = clustered(df, "user_id", [("timestamp", True), ("count", True)], partitions=4)
    parts = out.withColumn("p", F.spark_partition_id()).collect()
    assert len({r["p"] for r in parts if r["user_id"] == "hot"}) > 1
    # inside each task: key ascending, then newest first
    by_part = {}
    for r in parts:
        by_part.setdefault(r["p"], []).append((r["user_id"], -r["timestamp"].timestamp(), -r["count"]))
    assert all(v == sorted(v) for v in by_part.values())
