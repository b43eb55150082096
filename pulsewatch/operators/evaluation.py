"""Detector evaluation: a binary classification report per key (AGG6).

Truth and prediction are sets of positive keys; every other key of the
universe is a negative. Labels are combined with one union + aggregation on
the key (no joins), the confusion counts with one more global aggregation
(partial sums, then a single row), and the report rows are derived from that
one row. Ratios with a zero denominator are 0, as in common practice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels of the report rows, in report order.
REPORT_LABELS = ["0", "1", "accuracy", "macro avg", "weighted avg"]


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den)


def _f1(p: Column, r: Column) -> Column:
    return F.when((p + r) == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))


def labels_per_key(truth: DataFrame, predicted: DataFrame, universe: DataFrame,
                   key: str = "user_id") -> DataFrame:
    """One row per key of the universe (or of either set): ``y_true``, ``y_pred``."""
    tagged = (
        universe.select(key, F.lit(0).alias("t"), F.lit(0).alias("p"))
        .unionByName(truth.select(key, F.lit(1).alias("t"), F.lit(0).alias("p")))
        .unionByName(predicted.select(key, F.lit(0).alias("t"), F.lit(1).alias("p")))
    )
    return tagged.groupBy(key).agg(F.max("t").alias("y_true"), F.max("p").alias("y_pred"))


def labels_from_flags(flags: DataFrame, predicted: DataFrame, key: str = "user_id",
                      truth_col: str = "y_true") -> DataFrame:
    """Like :func:`labels_per_key` when the universe already carries the truth
    flag (one row per key with a 0/1 ``truth_col``): one input instead of two."""
    tagged = (
        flags.select(key, F.col(truth_col).cast("int").alias("t"), F.lit(0).alias("p"))
        .unionByName(predicted.select(key, F.lit(0).alias("t"), F.lit(1).alias("p")))
    )
    return tagged.groupBy(key).agg(F.max("t").alias("y_true"), F.max("p").alias("y_pred"))


def confusion(labels: DataFrame) -> DataFrame:
    """tp, fp, fn, tn of the positive class, as one row."""
    yt, yp = F.col("y_true") == 1, F.col("y_pred") == 1
    as_int = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return labels.agg(
        as_int(yt & yp).alias("tp"),
        as_int(~yt & yp).alias("fp"),
        as_int(yt & ~yp).alias("fn"),
        as_int(~yt & ~yp).alias("tn"),
    )


def report_from_confusion(conf: DataFrame, digits: int | None = 6) -> DataFrame:
    """Rows: ``label``, ``precision``, ``recall``, ``f1_score``, ``support``."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    # Class 1 is the positive class; for class 0 the roles swap.
    p1, r1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    p0, r0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp)
    f1, f0 = _f1(p1, r1), _f1(p0, r0)
    s1, s0 = tp + fn, tn + fp
    total = s0 + s1
    acc = _ratio(tp + tn, total)

    def w(a: Column, b: Column) -> Column:
        return _ratio(a * s0 + b * s1, total)

    rnd = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    rows = [
        ("0", p0, r0, f0, s0),
        ("1", p1, r1, f1, s1),
        ("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), acc, total),
        ("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, total),
        ("weighted avg", w(p0, p1), w(r0, r1), w(f0, f1), total),
    ]
    structs = [
        F.struct(
            F.lit(label).alias("label"),
            rnd(p.cast("double")).alias("precision"),
            rnd(r.cast("double")).alias("recall"),
            rnd(f.cast("double")).alias("f1_score"),
            s.cast("long").alias("support"),
        )
        for label, p, r, f, s in rows
    ]
    return conf.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def classification_report(
    truth: DataFrame,
    predicted: DataFrame,
    universe: DataFrame,
    key: str = "user_id",
    digits: int | None = 6,
) -> DataFrame:
    """AGG6: precision, recall, F1, support per class; accuracy; macro and weighted avg."""
    return report_from_confusion(confusion(labels_per_key(truth, predicted, universe, key)), digits)
