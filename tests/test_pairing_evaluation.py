import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from pulsewatch.operators.evaluation import classification_report
from pulsewatch.operators.pairing import positional_pair, rank_within
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 1)


def _ev(spark, rows):
    return spark.createDataFrame(
        [(u, i, T0 + dt.timedelta(seconds=s)) for u, i, s in rows],
        "user_id string, id long, ts timestamp",
    )


def test_pairing_drops_surplus_and_breaks_ties_by_id(spark):
    left = _ev(spark, [("u", 2, 0), ("u", 1, 0), ("u", 3, 5), ("v", 9, 1)])
    right = _ev(spark, [("u", 10, 7), ("u", 11, 8)])
    out = sorted(tuple(r) for r in positional_pair(left, right, "user_id", "ts", ["id"]).select(
        "user_id", "rn", "left_id", "right_id").collect())
    assert out == [("u", 1, 1, 10), ("u", 2, 2, 11)]


def test_rank_within_equals_row_number(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    brute = ev.withColumn(
        "expected", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    for bucket in ["1 minute", "1 hour", "7 days"]:
        got = rank_within(ev, "user_id", "ts", ["event_id"], bucket)
        diff = got.join(brute, "event_id").filter(F.col("rn") != F.col("expected"))
        assert diff.count() == 0, bucket
        assert got.count() == ev.count()


def test_pairing_reads_rows_once_and_shuffles_them_once(spark):
    from pulsewatch.operators.pairing import pair_kinds

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("user_id", "event_id", "ts", "event_type")
    out = pair_kinds(ev, "event_type", "view", "click", "user_id", "ts", ["event_id"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    # One scan of the rows, one of the totals' columns; rows, totals (twice), offsets, pairs.
    assert final.count("FileScan") == 2
    assert final.count(" Exchange ") <= 5


def _report(spark, truth, pred, universe):
    mk = lambda xs: spark.createDataFrame([(x,) for x in xs], "user_id string")
    rows = classification_report(mk(truth), mk(pred), mk(universe)).collect()
    return {r["label"]: r for r in rows}


def test_report_one_of_each(spark):
    rep = _report(spark, ["tp", "fn"], ["tp", "fp"], ["tp", "fp", "fn", "tn"])
    for label in ["0", "1", "macro avg", "weighted avg"]:
        assert (rep[label]["precision"], rep[label]["recall"], rep[label]["f1_score"]) == (0.5, 0.5, 0.5)
    assert rep["accuracy"]["f1_score"] == 0.5
    assert rep["1"]["support"] == 2 and rep["accuracy"]["support"] == 4


def test_report_no_positives_gives_zero_not_error(spark):
    rep = _report(spark, [], [], ["a", "b"])
    assert (rep["1"]["precision"], rep["1"]["recall"], rep["1"]["f1_score"]) == (0.0, 0.0, 0.0)
    assert rep["0"]["recall"] == 1.0 and rep["accuracy"]["f1_score"] == 1.0


def test_report_matches_sklearn_formulas(spark):
    # 3 TP, 1 FP, 2 FN, 4 TN
    universe = [f"u{i}" for i in range(10)]
    truth = ["u0", "u1", "u2", "u3", "u4"]
    pred = ["u0", "u1", "u2", "u9"]
    rep = _report(spark, truth, pred, universe)
    p1, r1 = 3 / 4, 3 / 5
    p0, r0 = 4 / 6, 4 / 5
    f1 = 2 * p1 * r1 / (p1 + r1)
    f0 = 2 * p0 * r0 / (p0 + r0)
    assert rep["1"]["precision"] == round(p1, 6) and rep["1"]["recall"] == round(r1, 6)
    assert rep["0"]["f1_score"] == round(f0, 6) and rep["1"]["f1_score"] == round(f1, 6)
    assert rep["weighted avg"]["f1_score"] == round((f0 * 5 + f1 * 5) / 10, 6)
    assert rep["accuracy"]["f1_score"] == 0.7


def test_labels_from_flags_equals_three_input_form(spark):
    from pulsewatch.operators.evaluation import (confusion, labels_from_flags,
                                                 labels_per_key)

    flags = spark.createDataFrame([("a", True), ("b", False), ("c", True), ("d", False)],
                                  "user_id string, y_true boolean")
    pred = spark.createDataFrame([("a",), ("b",)], "user_id string")
    one = confusion(labels_from_flags(flags, pred)).first().asDict()
    truth = flags.filter("y_true").select("user_id")
    three = confusion(labels_per_key(truth, pred, flags.select("user_id"))).first().asDict()
    assert one == three == {"tp": 1, "fp": 1, "fn": 1, "tn": 1}
