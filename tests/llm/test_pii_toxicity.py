import random
import re
import zlib

import numpy as np

from pulsewatch.llm import pii, toxicity
from pulsewatch.llm.common import table
from tests.llm.cases import TEXTS, documents

SF = "/root/testdata/sf0.01"

_PLAIN = [re.compile(p) for p in (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def _base(text):
    out = []
    for kind, pattern in enumerate(_PLAIN):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == 2 and not (16 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == 3 and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_the_plain_patterns():
    r = random.Random(1)
    bits = ["a", "b.", "@", "1", "23", "4.", "255", "300", ".", "-", " ", "+", "(", ")", "4111111111111111", "x@y.z",
            "+1 555", "\n", "é", "%"]
    for _ in range(5000):
        text = "".join(r.choice(bits) for _ in range(r.randint(0, 30)))
        assert pii.base_spans(text) == _base(text)


def test_long_runs_stay_linear():
    import time

    began = time.time()
    pii.base_spans("1" * 300_000 + " " + "a@" * 100_000 + "+1" * 100_000 + "." * 100_000)
    assert time.time() - began < 10


def test_find_keeps_base_spans_and_adds_only_tokens(spark):
    docs = table(spark, SF, "documents")
    model = pii.fit(docs)
    for r in pii.find(docs, model).select("text", "spans").collect():
        text = r["text"] or ""
        got = [(pii.KINDS.index(s["kind"]), s["start"], s["end"]) for s in r["spans"] if s["base"]]
        assert got == _base(text)
        for s in r["spans"]:
            if not s["base"]:
                assert re.search(r"[0-9@]", text[s["start"]:s["end"]])
                assert not any(a < s["end"] and s["start"] < b for _, a, b in _base(text))


def _model():
    lines = [f"call +1 ({200 + i}) 555-{1000 + i} or mail u{i}@h{i % 7}.example.com at 10.0.{i}.7 then {i} items"
             for i in range(150)]
    return pii.train([pii.graph_of(t, pii.base_spans(t)) for t in lines], pii.Settings())


def test_repeated_and_cut_off_entities_are_labelled_alike():
    model, settings = _model(), pii.Settings()
    text = "call +1 (269) 555-3296 today and later (269) 555-3296 again"
    spans = pii.all_spans(text, model, settings)
    assert (3, 5, 22, True) in spans
    assert ("(269) 555-3296").strip("(") in [text[a:b] for k, a, b, base in spans if k == 3 and not base]
    assert pii.all_spans("we had 12 items in 2024", model, settings) == []


def test_skip_edges_carry_evidence():
    """A token the node potentials leave open follows its equal, held token elsewhere."""
    graph = pii.Graph([(0, 5), (50, 55)], [["same"], ["same"]], np.array([0, -1]), [], [(0, 1)])
    alone = pii.Graph([(0, 5)], [["same"]], np.array([-1]), [], [])
    model = pii.Model({"same": 0}, np.zeros((1, pii.LABELS)), np.zeros((pii.LABELS,) * 2), 3 * np.eye(pii.LABELS))
    settings = pii.Settings()
    assert pii.marginals(model, graph, settings)[1, 0] > 0.8
    assert abs(pii.marginals(model, alone, settings)[0, 0] - 1 / pii.LABELS) < 1e-9


def test_pii_cases(spark):
    docs = documents(spark)
    model = pii.fit(docs)
    assert pii.find(docs, model).count() == len(TEXTS)
    empty = docs.limit(0)
    assert pii.find(empty, pii.fit(empty)).collect() == []
    assert pii.all_spans("bob@example.com", pii.Model(), pii.Settings()) == [(0, 0, 15, True)]


# --- toxicity ---------------------------------------------------------------------

def test_held_out_rows(spark):
    rows = spark.range(200).withColumnRenamed("id", "doc_id").select("doc_id", toxicity.held_out().alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    scored = toxicity.toxicity(docs.select("doc_id", "text"), docs, labels).filter("held_out").join(labels, "doc_id")
    rows = [(r["toxic"], r["predicted"]) for r in scored.select("toxic", "predicted").collect()]
    hits = sum(a == b == 1 for a, b in rows)
    assert hits / max(1, sum(b for _, b in rows)) > 0.95   # precision
    assert hits / sum(a for a, _ in rows) > 0.7            # recall


def test_labels_of_held_out_rows_are_not_used(spark):
    from pyspark.sql import functions as F

    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs.repartition(7), flipped)
    assert a.bias == b.bias and np.array_equal(a.slots, b.slots) and np.array_equal(a.values, b.values)


def test_toxicity_cases(spark):
    docs = documents(spark)
    labels = spark.createDataFrame([(0, 1, 1), (1, 0, None), (4, 0, 0), (4, 0, 1), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    for rows, known in ((docs, labels), (docs, labels.limit(0)), (docs.limit(0), labels)):
        out = toxicity.toxicity(rows.select("doc_id", "text"), docs, known).collect()
        assert len(out) == rows.count()
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)
    model = toxicity.fit(docs, labels)
    kept = toxicity.accepted(docs, model)
    assert kept.columns == docs.columns


def test_scores_do_not_depend_on_slices():
    texts = ["you idiot", "a fine day", "", "idiot idiot clown", "x " * 1000]
    data = [t.encode() for t in texts]
    joined = np.frombuffer(b"".join(data), np.uint8)
    offsets = np.cumsum([0, *map(len, data)])
    row, slot = toxicity.slots_of(joined, offsets, 20)
    for i, raw in enumerate(data):
        _, own = toxicity.slots_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), 20)
        assert sorted(own) == sorted(slot[row == i])


# --- the field's marginals and the classifier against plain ones ------------------------

def _all_labellings(model, graph):
    """Marginals by summing over every labelling."""
    import itertools

    node = model.potentials(graph)
    n = len(graph.places)
    out = np.zeros((n, pii.LABELS))
    for labels in itertools.product(range(pii.LABELS), repeat=n):
        if any(h >= 0 and labels[i] != h for i, h in enumerate(graph.held)):
            continue
        score = sum(node[i, y] for i, y in enumerate(labels))
        score += sum(model.chain[labels[a], labels[b]] for a, b in graph.chain)
        score += sum(model.skip[labels[a], labels[b]] for a, b in graph.skip)
        for i, y in enumerate(labels):
            out[i, y] += np.exp(score)
    return out / out.sum(axis=1, keepdims=True)


def _random_graph(r, n, loops):
    """A tree of chain and skip edges, and a loop more if asked for."""
    edges = [(r.randrange(i), i) for i in range(1, n)]
    chain = [e for e in edges if e[1] - e[0] == 1]
    skip = [e for e in edges if e[1] - e[0] > 1]
    if loops:
        free = [(a, b) for b in range(n) for a in range(b) if (a, b) not in edges]
        skip.append(r.choice(free))
    held = np.array([r.randrange(pii.LABELS) if r.random() < 0.3 else -1 for _ in range(n)])
    return pii.Graph([(i, i + 1) for i in range(n)], [[f"f{r.randrange(4)}"] for _ in range(n)], held, chain, skip)


def test_marginals_equal_enumeration_on_trees_and_are_near_on_loops():
    r, rng = random.Random(4), np.random.default_rng(4)
    settings = pii.Settings(passes=60)
    for loops in (False, True):
        worst = 0.0
        for _ in range(25):
            model = pii.Model({f"f{i}": i for i in range(4)}, rng.normal(0, 1, (4, pii.LABELS)),
                              rng.normal(0, 0.7, (pii.LABELS,) * 2), np.eye(pii.LABELS) * 1.5)
            graph = _random_graph(r, r.randint(3, 5), loops)
            worst = max(worst, np.abs(pii.marginals(model, graph, settings) - _all_labellings(model, graph)).max())
        assert worst < (0.2 if loops else 1e-9), (loops, worst)


def test_the_default_number_of_passes_suffices_on_trees():
    r, rng = random.Random(5), np.random.default_rng(5)
    for _ in range(25):
        model = pii.Model({f"f{i}": i for i in range(4)}, rng.normal(0, 1, (4, pii.LABELS)),
                          rng.normal(0, 0.7, (pii.LABELS,) * 2), np.eye(pii.LABELS) * 1.5)
        graph = _random_graph(r, r.randint(3, 5), False)
        assert np.abs(pii.marginals(model, graph, pii.Settings()) - _all_labellings(model, graph)).max() < 0.02


def test_training_equals_a_plain_ftrl_proximal():
    """Coordinate by coordinate, from the definition: z and n per slot, w by the closed form of the proximal step."""
    import math

    rng = np.random.default_rng(8)
    settings = toxicity.Settings(bits=6, alpha=0.5, beta=1.0, l1=0.3, l2=0.2, epochs=3)
    examples = [(np.unique(rng.integers(0, 64, 8)), int(rng.random() < 0.4)) for _ in range(60)]
    z, n = dict.fromkeys(range(64), 0.0), dict.fromkeys(range(64), 0.0)
    share = (sum(y for _, y in examples) + 0.5) / (len(examples) + 1)
    bias, bias_n = math.log(share / (1 - share)), 0.0

    def weight(i):
        if abs(z[i]) <= settings.l1:
            return 0.0
        sign = 1.0 if z[i] > 0 else -1.0
        return -(z[i] - sign * settings.l1) / ((settings.beta + math.sqrt(n[i])) / settings.alpha + settings.l2)

    order = np.random.Generator(np.random.PCG64(7))
    for _ in range(settings.epochs):
        for k in order.permutation(len(examples)):
            slots, label = examples[k]
            w = {int(i): weight(int(i)) for i in slots}
            g = 1 / (1 + math.exp(-(bias + sum(w.values())))) - label
            for i in w:
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / settings.alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
            bias_n += g * g
            bias -= settings.alpha * 0.1 / (settings.beta + math.sqrt(bias_n)) * g
    model = toxicity.train(examples, settings)
    want = {i: weight(i) for i in range(64) if weight(i)}
    assert 0 < len(want) < 64 and model.slots.tolist() == sorted(want)
    assert np.allclose(model.values, [want[i] for i in sorted(want)], rtol=1e-5) and abs(model.bias - bias) < 1e-9
