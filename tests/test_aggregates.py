import datetime as dt

from pyspark.sql import functions as F

from pulsewatch.operators import aggregates as agg
from pulsewatch.schemas import events_as_metrics
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)


def _rows(spark, rows):
    return spark.createDataFrame(
        [(T0 + dt.timedelta(seconds=s), u, k, a) for s, u, k, a in rows],
        "timestamp timestamp, user_id string, operation_type string, action_id string",
    )


def test_views_per_minute_counts_and_distinct(spark):
    df = _rows(spark, [(0, "u1", "VIEW", "x"), (10, "u1", "VIEW", "x"), (59, "u2", "VIEW", "y"),
                       (60, "u1", "VIEW", "x"), (30, "u3", "BUY", "x")])
    out = {r["timestamp"]: (r["views"], r["distinct_users"], r["dummy_id"])
           for r in agg.views_per_window(df, "1 minute", distinct="exact").collect()}
    assert out == {T0: (3, 2, "1"), T0 + dt.timedelta(minutes=1): (1, 1, "1")}


def test_transactions_use_the_reference_kinds(spark):
    df = _rows(spark, [(0, "u1", k, "x") for k in ["VIEW", "TRANSACTION", "BUY", "CANCEL", "REFUND"]])
    out = agg.transactions_per_window(df, "1 minute", distinct="approx").first()
    assert out["transactions"] == 4  # TRANSACTION itself is not counted


def test_burst_counts_sum_to_row_count(spark):
    ev = events_as_metrics(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    for width in ["5 seconds", "1 hour", "1 day"]:
        total = agg.burst_counts(ev, width).agg(F.sum("count")).first()[0]
        assert total == ev.count()


def test_burst_counts_keep_actions_apart(spark):
    df = _rows(spark, [(0, "u1", "VIEW", "a"), (1, "u1", "VIEW", "b"), (2, "u1", "VIEW", "a"),
                       (6, "u1", "VIEW", "a")])
    out = sorted((r["timestamp"].second, r["action_id"], r["count"])
                 for r in agg.burst_counts(df, "5 seconds").collect())
    assert out == [(0, "a", 2), (0, "b", 1), (5, "a", 1)]


def test_approx_distinct_within_bound(spark):
    ev = events_as_metrics(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    assert all(r["within_bound"] for r in agg.distinct_within_bound(ev).collect())


def test_filters(spark):
    from pulsewatch.operators import filters as flt

    df = spark.createDataFrame(
        [(T0, "VIEW", 0, 1), (T0 + dt.timedelta(days=1), "BUY", 1, 60), (T0 + dt.timedelta(days=2), None, 1, 51)],
        "timestamp timestamp, operation_type string, attack int, n long")
    assert flt.of_kind(df, "VIEW").count() == 1
    assert flt.of_kinds(df, ["VIEW", "BUY"]).count() == 2
    assert flt.on_day(df, dt.date(2024, 1, 2)).first()["operation_type"] == "BUY"
    assert flt.in_days(df, dt.date(2024, 1, 2), dt.date(2024, 1, 3)).count() == 2
    assert flt.above(df, "n", 50).count() == 2 and flt.above(df, "n", 51).count() == 1
    assert flt.labelled(df, "attack", 1).count() == 2
    lo, hi = T0, T0 + dt.timedelta(days=2)
    assert flt.panel_range(df, "n", None, "timestamp", lo, hi).count() == 1
    assert flt.panel_range(df, "n", [1, 51], "timestamp", lo, hi).count() == 0


def test_sort_by_time_breaks_ties(spark):
    from pulsewatch.operators.ordering import sort_by_time

    t = dt.datetime(2024, 1, 1)
    rows = [(2, t), (1, t + dt.timedelta(seconds=1)), (1, t)]
    df = spark.createDataFrame(rows, "id long, timestamp timestamp").repartition(3)
    assert [(r["id"], r["timestamp"]) for r in sort_by_time(df, "timestamp", "id").collect()] == [
        (1, t), (2, t), (1, t + dt.timedelta(seconds=1))]
