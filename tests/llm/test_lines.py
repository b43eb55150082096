import itertools
import zlib

import numpy as np
import pytest

from pulsewatch.llm import lines
from pulsewatch.llm.common import table
from tests.llm.cases import LONG, TEXTS, documents

SF = "/root/testdata/sf0.01"


def _slice(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def _enumerated(node, chain):
    """Marginals of one chain by summing over all labellings."""
    good, joint, total = np.zeros(len(node)), np.zeros((len(node), 2, 2)), 0.0
    for labels in itertools.product((0, 1), repeat=len(node)):
        weight = np.exp(sum(n * y for n, y in zip(node, labels, strict=True))
                        + sum(chain[a, b] for a, b in itertools.pairwise(labels)))
        total += weight
        good += weight * np.array(labels)
        for t, (a, b) in enumerate(itertools.pairwise(labels)):
            joint[t, a, b] += weight
    return good / total, joint / total


def test_messages_equal_enumeration():
    r = np.random.default_rng(5)
    for _ in range(60):
        sizes = r.integers(1, 9, int(r.integers(1, 6)))
        row = np.repeat(np.arange(len(sizes)), sizes)
        node, chain = r.normal(0, 3, len(row)), r.normal(0, 2, (2, 2))
        good, joint = lines.messages(row, node, chain)
        for i in range(len(sizes)):
            at = np.flatnonzero(row == i)
            want, pairs = _enumerated(node[at], chain)
            assert np.allclose(good[at], want, atol=1e-12) and np.allclose(joint[at], pairs, atol=1e-12)
    assert lines.messages(np.zeros(0, int), np.zeros(0), np.zeros((2, 2)))[0].shape == (0,)


def test_messages_of_long_chains_stay_finite():
    """Against the two recursions, line by line."""
    r = np.random.default_rng(6)
    n = 50_000
    node, chain = r.normal(0, 20, n), np.array([[4.0, -4.0], [-4.0, 4.0]])
    good, joint = lines.messages(np.zeros(n, int), node, chain)
    local = np.stack([np.ones(n), np.exp(np.clip(node, -30, 30))], axis=1)
    forward, backward = np.ones((n, 2)), np.ones((n, 2))
    for t in range(n):
        forward[t] = local[t] * (forward[t - 1] @ np.exp(chain) if t else 1)
        forward[t] /= forward[t].sum()
    for t in range(n - 2, -1, -1):
        backward[t] = np.exp(chain) @ (local[t + 1] * backward[t + 1])
        backward[t] /= backward[t].sum()
    both = forward * backward
    assert np.isfinite(good).all() and np.isfinite(joint).all()
    assert np.allclose(good, both[:, 1] / both.sum(axis=1), atol=1e-9)


def test_gradient_is_that_of_the_likelihood():
    """Expected counts are the slope of the log partition function."""
    r = np.random.default_rng(7)
    row = np.repeat([0, 1, 2], [4, 1, 3])
    node, chain = r.normal(0, 1, len(row)), r.normal(0, 1, (2, 2))

    def log_partition(node, chain):
        out = 0.0
        for i in range(3):
            at = np.flatnonzero(row == i)
            out += np.log(sum(np.exp(sum(node[t] * y for t, y in zip(at, labels, strict=True))
                                     + sum(chain[a, b] for a, b in itertools.pairwise(labels)))
                              for labels in itertools.product((0, 1), repeat=len(at))))
        return out

    good, joint = lines.messages(row, node, chain)
    for t in range(len(row)):
        step = np.eye(len(row))[t] * 1e-5
        assert abs((log_partition(node + step, chain) - log_partition(node - step, chain)) / 2e-5 - good[t]) < 1e-6
    for a, b in itertools.product((0, 1), repeat=2):
        step = np.zeros((2, 2))
        step[a, b] = 1e-5
        slope = (log_partition(node, chain + step) - log_partition(node, chain - step)) / 2e-5
        assert abs(slope - joint[:, a, b].sum()) < 1e-6


def test_measures_do_not_depend_on_slices():
    texts = ["One line.\nTWO!! LINES!!\n\nOne line.", "", "a | b | c |", "\n\n", " ", "Der Der Der", "é ü\tz", LONG, "x" * 5000]
    data, offsets = _slice(texts)
    row, visible, bins = lines.lines_of(data, offsets)
    slots = lines.slots_of(row, bins)
    for i, text in enumerate(texts):
        own = _slice([text])
        r, v, b = lines.lines_of(*own)
        assert np.array_equal(v, visible[row == i]) and np.array_equal(b, bins[row == i])
        assert np.array_equal(lines.slots_of(r, b), slots[row == i])
        kept = [x for x in text.split("\n") if x]
        assert len(kept) == len(b) and [sum(not c.isspace() for c in x) for x in kept] == v.tolist()
    assert lines.SLOTS * lines.BINS > slots.max() and bins.max() < lines.BINS


def test_neighbouring_lines_decide():
    """A line that says nothing by itself follows the lines around it."""
    model = lines.Model(0.5, np.zeros(lines.SLOTS * lines.BINS), 2 * np.eye(2))
    node = np.array([4.0, 0.0, 4.0, -4.0, 0.0, -4.0, 0.0])
    good, _ = lines.messages(np.array([0, 0, 0, 1, 1, 1, 2]), node, model.chain)
    assert good[1] > 0.9 and good[4] < 0.1 and abs(good[6] - 0.5) < 1e-12


@pytest.fixture(scope="module")
def fitted(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    return docs, labels, lines.fit(docs, labels)


def test_held_out_accuracy(spark, fitted):
    docs, labels, model = fitted
    rows = (lines.score(docs.select("doc_id", "text"), model).join(labels, "doc_id")
            .filter(lines.held_out()).select("quality", "score").collect())
    assert len(rows) > 1000
    good = [r["score"] for r in rows if r["quality"]]
    bad = [r["score"] for r in rows if not r["quality"]]
    assert np.mean([s >= 0.5 for s in good]) > 0.99
    assert np.mean([s < 0.5 for s in bad]) > 0.9
    order = np.argsort([r["score"] for r in rows], kind="stable")
    rank = np.empty(len(rows))
    rank[order] = np.arange(1, len(rows) + 1)
    area = (sum(rank[i] for i, r in enumerate(rows) if r["quality"]) - len(good) * (len(good) + 1) / 2) / (len(good) * len(bad))
    assert area > 0.97


def test_a_good_line_inside_junk_is_told_apart(spark, fitted):
    docs, labels, model = fitted
    text = ("Thnd*** iner*** ther*** ththsh$$$ ountin$$$ ntnd*** that*** a,%%%\n"
            + "The and attion to the other anea. Eriner thanea in the thinsh.\n" * 2
            + "Thhastnd&&& the&&& the&&& on%%% the&&& ha%%% or$$$ st%%% atnd***\n" * 3)
    _, _, good = lines.line_scores(*_slice([text]), model)
    assert good[0] < 0.5 and (good[3:] < 0.5).all()
    assert lines.document_scores(*_slice([text]), model)[0] < 0.5


def test_held_out_rows(spark):
    rows = spark.range(200).withColumnRenamed("id", "doc_id").select("doc_id", lines.held_out().alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)


def test_labels_of_held_out_rows_are_not_used(spark):
    from pyspark.sql import functions as F

    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    flipped = labels.withColumn("quality", F.when(lines.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = lines.fit(docs, labels), lines.fit(docs.repartition(7), flipped)
    assert a.prior == b.prior and np.array_equal(a.node, b.node) and np.array_equal(a.chain, b.chain)


def test_quality_cases(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(0, 1, 1), (1, None, 0), (3, 0, 0), (3, 1, 0), (4, 1, 0), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    for rows, known in ((docs, labels), (docs, labels.limit(0)), (docs.limit(0), labels)):
        out = lines.quality(rows.select("doc_id", "text"), docs, known).collect()
        assert len(out) == rows.count()
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    nothing = lines.quality(docs.select("doc_id", "text"), docs, labels.limit(0)).collect()
    assert {r["score"] for r in nothing if not (r["text"] or "").strip()} == {0.5}
    # Columns named like the results are replaced, others stay.
    out = lines.quality(docs, docs, labels)
    assert out.count() == len(TEXTS) and {"spans", "fingerprint", "score", "held_out", "predicted"} <= set(out.columns)
