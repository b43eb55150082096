import datetime as dt

import pytest
from pyspark.sql import functions as F

from pulsewatch.sinks.series import read_series, write_series

T0 = dt.datetime(2024, 1, 1)
USERS, DAYS, PER_DAY = 500, 4, 40


@pytest.fixture(scope="module")
def table(spark):
    from pulsewatch.session import scratch_path

    rows = spark.range(USERS * DAYS * PER_DAY).select(
        (F.pmod(F.xxhash64("id"), F.lit(USERS)) * 2).alias("user_id"),       # even ids only
        F.timestamp_seconds(F.lit(int(T0.timestamp())) + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(DAYS * 86_400)))
        .alias("ts"), F.col("id").cast("double").alias("value")).persist()
    path = write_series(rows, scratch_path(spark, "series"), "user_id", "ts", ids_per_group=200, block_bytes=16 << 10,
                        partitions=8)
    yield rows, path
    rows.unpersist()


def _scan_metric(df, name):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().apply(name).value()


def _read(spark, table, ids, first, last):
    rows, path = table
    return read_series(spark, path, rows.schema, "user_id", "ts", ids, first, last)


def test_a_panel_reads_the_rows_it_asks_for(spark, table):
    rows, _ = table
    for ids in ([42], [0, 998, 500], [43], None):
        got = _read(spark, table, ids, T0, T0 + dt.timedelta(days=2))
        want = rows.filter((F.col("ts") > F.lit(T0)) & (F.col("ts") < F.lit(T0 + dt.timedelta(days=2))))
        want = want.filter(F.col("user_id").isin(ids)) if ids else want
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_one_id_opens_few_row_groups(spark, table):
    import os

    import pyarrow.parquet as pq

    rows, path = table
    footers = [pq.ParquetFile(os.path.join(d, f)).metadata for d, _, names in os.walk(path)
               for f in names if f.endswith(".parquet")]
    groups = [m.row_group(i) for m in footers for i in range(m.num_row_groups)]
    largest = max(g.num_rows for g in groups)
    assert len(groups) > 10 * DAYS
    one = _read(spark, table, [42], T0, T0 + dt.timedelta(days=DAYS))
    read = _scan_metric(one, "numOutputRows")
    # An id is one run a day: at most two row groups of each day, of the many there are.
    assert 0 < one.count() <= read <= 2 * DAYS * largest < rows.count() / 4
    day = _read(spark, table, [42], T0 + dt.timedelta(hours=1), T0 + dt.timedelta(hours=23))
    assert _scan_metric(day, "numOutputRows") <= 2 * largest and _scan_metric(day, "numFiles") < len(footers)


def test_bloom_filters_spare_row_groups_without_the_id(spark, table):
    # Odd ids lie inside the ranges of ids, but are in no row group.
    odd = _read(spark, table, [43, 501], T0, T0 + dt.timedelta(days=DAYS))
    assert _scan_metric(odd, "numOutputRows") == 0
    even = _read(spark, table, [42, 500], T0, T0 + dt.timedelta(days=DAYS))
    assert _scan_metric(even, "numOutputRows") > 0
