import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsewatch.operators.indexing import IndexedBatches, _laid, row_index, union_indexed
from pulsewatch.operators.ordering import top_n_per_key
from pulsewatch.operators.pairing import pair_tables
from pulsewatch.schemas import EVENTS
from pulsewatch.sinks.archive import write_extract
from pulsewatch.sources.files import read_csv_extract
from tests.conftest import SF_SMALL


def _rows(spark, n=500, seed=1):
    r = random.Random(seed)
    # A third of the rows share one key; times repeat; some are null; whole rows repeat.
    rows = [(0 if r.random() < 0.33 else r.randint(1, 60), r.choice([None, "a", "b", "ü"]), r.randint(0, 3)) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "t long, s string, _place int")


def test_index_equals_a_sort_on_the_driver(spark):
    rows, df = _rows(spark)
    for partitions in (1, 3, 16):
        got = row_index(df.repartition(5), ["t", F.col("s").desc(), "_place"], partitions=partitions).collect()
        assert sorted(r["index"] for r in got) == list(range(len(rows)))
        want = sorted(rows, key=lambda x: (x[0], {None: 3, "a": 2, "b": 1, "ü": 0}[x[1]], x[2]))
        assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r["index"])] == want


def test_index_cases(spark):
    _, df = _rows(spark)
    assert row_index(df.limit(0), ["t"]).collect() == []
    # An existing column of the output's name is replaced, and may be the order.
    again = row_index(df.withColumn("Index", F.col("t")), ["Index", "s", "_place"], start=7)
    assert again.columns == ["t", "s", "_place", "index"]
    assert sorted(r["index"] for r in again.collect()) == list(range(7, 507))
    same = spark.range(1000).select(F.lit("x").alias("x"))
    assert sorted(r["i"] for r in row_index(same, ["x"], "i").collect()) == list(range(1000))


def test_equal_rows_spread_over_the_ranges(spark):
    same = spark.range(8000).select(F.lit("x").alias("x"))
    laid = _laid(same, ["x"], ["x"], "_place", 8)
    plan = laid._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "SinglePartition" not in plan
    sizes = [r["n"] for r in laid.groupBy(F.shiftright("_place", 33).alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 3000


def test_batches_keep_their_sequence(spark):
    rows, df = _rows(spark)
    late, early = df.filter("t < 30"), df.filter("t >= 30")
    got = sorted(union_indexed([early, late], ["t", "s", "_place"]).collect(), key=lambda r: r["index"])
    n = early.count()
    assert [r["index"] for r in got] == list(range(len(rows)))
    assert all(r["t"] >= 30 for r in got[:n]) and all(r["t"] < 30 for r in got[n:])
    assert [r["t"] for r in got[:n]] == sorted(r["t"] for r in got[:n])


def test_appending_numbers_the_new_batch_only(spark, scratch):
    rows, df = _rows(spark)
    table = IndexedBatches(spark, f"{scratch}/batches")
    assert table.append(0, df, ["t"]) == 0
    before = {tuple(r) for r in table.read().collect()}
    assert table.append(1, df.limit(20), ["t"]) == len(rows)
    assert table.append(1, df.limit(30), ["t"]) == len(rows)      # a replay replaces itself
    after = table.read().collect()
    assert before <= {tuple(r) for r in after}
    assert sorted(r["index"] for r in after) == list(range(len(rows) + 30))
    assert table.append(0, df, ["t"]) == 0                        # same size: later numbers still follow on
    with pytest.raises(ValueError, match="batch 0"):
        table.append(0, df.limit(3), ["t"])
    assert table.read().count() == len(rows) + 30


def test_extract_with_an_index_column_round_trips(spark, scratch):
    ev = spark.read.schema(EVENTS).parquet(f"{SF_SMALL}/events.parquet")
    indexed = row_index(ev, ["ts", "event_id"])
    path = write_extract(indexed, f"{scratch}/extract", index_col="index")
    parts = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert all(pd.read_csv(f"{path}/{f}").columns[0] == "Unnamed: 0" for f in parts)
    kept = read_csv_extract(spark, path, EVENTS, index_col="index")
    assert kept.columns[0] == "index" and kept.select(*indexed.columns).exceptAll(indexed).count() == 0
    dropped = read_csv_extract(spark, path, EVENTS, index_col="Unnamed: 0")
    assert dropped.columns == ev.columns and dropped.exceptAll(ev).count() == 0 and dropped.count() == ev.count()


def test_pairing_by_position(spark):
    left = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b"), (2, "bb")], "k int, rn string")
    right = spark.createDataFrame([(10.0,), (9.0,), (8.0,)], "x double")
    out = pair_tables(left, right, ["k", "rn"], [F.col("x").desc()]).orderBy("rn")
    assert out.columns == ["rn", "left_k", "right_x"]
    assert [tuple(r) for r in out.collect()] == [(1, 1, 10.0), (2, 2, 9.0), (3, 2, 8.0)]
    with pytest.raises(ValueError, match="4 rows with 3"):
        pair_tables(left, right, ["k", "rn"], ["x"], strict=True)
    assert pair_tables(left, right, ["k"], ["x"], partitions=2).count() == 3
    assert pair_tables(left.limit(0), right, ["k"], ["x"]).collect() == []


def test_newest_rows_of_every_key(spark):
    rows, df = _rows(spark)
    got = top_n_per_key(df.repartition(6), 4, "s", [F.col("t").desc(), F.col("_place").desc()]).collect()
    for key in (None, "a", "b", "ü"):
        own = sorted(((t, p) for t, s, p in rows if s == key), reverse=True)[:4]
        assert [(r["t"], r["_place"]) for r in sorted(got, key=lambda r: r["place"]) if r["s"] == key] == own
