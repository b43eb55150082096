import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pulsewatch.llm import setsketch
from pulsewatch.llm.common import byte_slices
from pulsewatch.llm.components import components
from tests.llm.cases import LONG, TEXTS, documents

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = {65 + i: 97 + i for i in range(26)}


def brute_force(rows, size, percent=80):
    sets = {}
    for i, text in rows:
        w = _WORD.findall((text or "").translate(_LOWER))
        sets[i] = frozenset([tuple(w)]) if 0 < len(w) < size else frozenset(
            tuple(w[j:j + size]) for j in range(len(w) - size + 1))
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for i, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(i)
    for i, s in sets.items():
        for j, n in Counter(j for g in s for j in where[g] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in sets)


def test_shingle_sets_equal_brute_force():
    texts = ["", "a", "a b", "a b c d e", "A b\tc\x0bD e  a b c d e", "é ü ö ß ñ", "x" * 50, "a b c d e " * 40]
    for limit in (1, 40, 10_000):
        counts = []
        for _, _, data, offsets in byte_slices(pa.array(texts), limit):
            _, at = setsketch.shingle_sets(data, offsets, 5)
            counts += np.diff(at).tolist()
        want = []
        for t in texts:
            w = _WORD.findall(t.translate(_LOWER))
            want.append(1 if 0 < len(w) < 5 else len({tuple(w[i:i + 5]) for i in range(len(w) - 4)}))
        assert counts == want


def test_sketches_merge_and_estimate():
    settings = setsketch.Settings()
    r = np.random.default_rng(1)
    for n, j in ((400, 0.8), (400, 0.5), (30, 0.8), (3000, 0.95)):
        shared = int(round(2 * n * j / (1 + j)))
        sets_a, sets_b, estimates = [], [], []
        for _ in range(40):
            u = r.integers(0, 2**63, 2 * n, dtype=np.uint64)
            sets_a.append(np.unique(u[:n]))
            sets_b.append(np.unique(np.concatenate([u[:shared], u[n:2 * n - shared]])))
        at = np.arange(41) * n
        a, b = (setsketch.sketches(np.concatenate(x), at, settings) for x in (sets_a, sets_b))
        both = [np.unique(np.concatenate(x)) for x in zip(sets_a, sets_b, strict=True)]
        union = setsketch.sketches(np.concatenate(both), np.cumsum([0, *map(len, both)]), settings)
        assert np.array_equal(np.maximum(a, b), union)  # mergeable
        estimates = setsketch.likely_jaccard(a, b, np.full(40, n), np.full(40, n), settings.base)
        assert abs(estimates.mean() - shared / (2 * n - shared)) < 0.03


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(200, 200), (7, 7), (300, 301), (301, 300)]
    r = random.Random(3)
    edges = [(b, a) if r.random() < 0.5 else (a, b) for a, b in edges]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("size", [4, 5])
def test_groups_equal_brute_force(spark, size):
    r = random.Random(size)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(16):
        base = [r.choice(words) for _ in range(r.choice([1, 3, 8, 30, 120]))]
        for _ in range(r.randint(1, 45)):
            t = list(base)
            for _ in range(r.randint(0, max(1, len(t) // 25))):
                t[r.randrange(len(t))] = r.choice(words)
            texts.append(" ".join(t))
    rows = list(enumerate(texts + ["", "  ", None, "a"] + ["the same text here x y"] * 30))
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(map(tuple, setsketch.near_duplicates(df, setsketch.Settings(shingle=size)).collect()))
    assert got == brute_force(rows, size)


def test_large_mixed_buckets_are_split(spark):
    """A passage most texts share, and a small true group among them; parts of at most 4 classes."""
    r = random.Random(9)
    words = [f"w{i}" for i in range(5000)]
    passage = [r.choice(words) for _ in range(100)]
    texts = [" ".join(passage + [r.choice(words) for _ in range(45)]) for _ in range(150)]
    for i in range(0, 40, 2):
        t = texts[i].split()
        t[120] = "changed"
        texts[i + 1] = " ".join(t)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, setsketch.near_duplicates(df, setsketch.Settings(shingle=4, small=4)).collect()))
    assert got == brute_force(rows, 4)


def edited(words, places, tag):
    """The text with a word of its own at each place."""
    out = list(words)
    for k in places:
        out[k] = f"{tag}x{k}"
    return out


def shared_words(x, y, size=4):
    a, b = ({tuple(t[i:i + size]) for i in range(len(t) - size + 1)} for t in (x, y))
    return len(a & b) / len(a | b)


def test_star_around_a_middle_id(spark):
    """2,000 copies, each alike to the original only, whose id is in their middle; a straggler alike to one copy only."""
    r = random.Random(17)
    original = [f"w{r.randrange(5000)}" for _ in range(120)]
    texts = [edited(original, sorted(r.sample(range(8, 112, 8), 3)), f"c{i}") for i in range(2000)]
    texts[1000] = original
    straggler = edited(texts[500], [2, 5, 118], "s")
    assert min(shared_words(original, t) for t in texts) >= 0.8
    assert shared_words(straggler, original) < 0.8 <= shared_words(straggler, texts[500])
    rows = list(enumerate(" ".join(t) for t in [*texts, straggler]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for sizes in ({}, {"block": 300}, {"block_bytes": 400_000}):
        out = setsketch.near_duplicates(df, setsketch.Settings(shingle=4, **sizes)).collect()
        assert {r["component_id"] for r in out} == {0} and [r["doc_id"] for r in out if r["kept"]] == [0]


def test_blocks_of_pairs_equal_all_pairs():
    r = np.random.default_rng(5)
    n = 700
    sketch = r.integers(0, 2, (16, n)).astype(np.uint16)
    sketch[:4] = 1  # the first band is shared by all
    x = {"id": r.permutation(n).astype(np.int64), "component": np.sort(r.integers(0, 300, n)),
         "n": r.integers(80, 120, n), "sketch": sketch}
    z, y = ({k: v[..., at] for k, v in x.items()} for at in (slice(0, 400), slice(400, n)))
    want = {(int(min(x["id"][i], x["id"][j])), int(max(x["id"][i], x["id"][j]))) for i in range(n) for j in range(i)
            if x["component"][i] != x["component"][j] and 9 <= (sketch[:, i] == sketch[:, j]).sum() < 12
            and 100 * min(x["n"][i], x["n"][j]) >= 80 * max(x["n"][i], x["n"][j])}
    got = [p for one, two in ((y, y), (z, z), (z, y))
           for p in zip(*map(np.ndarray.tolist, setsketch.agreeing(one, two, 9, 12, 80, (0, 4))), strict=True)]
    assert len(got) == len(want) and set(got) == want
    assert not len(setsketch.agreeing(x, x, 9, 12, 80, (1, 4))[0])  # found in the first band's bucket already


def _sets(spark_free_sets):
    return setsketch.Sets(pa.array([np.array(sorted(x), np.uint64).tobytes() for x in spark_free_sets], pa.binary()))


def test_shared_counts_equal_set_intersections():
    r = random.Random(2)
    sets = [{r.randrange(40) for _ in range(r.randint(1, 30))} for _ in range(60)]
    block = _sets(sets)
    for one in range(60):
        others = np.array(r.sample(range(60), 20))
        assert block.shared(one, others).tolist() == [len(sets[one] & sets[o]) for o in others]


def test_links_of_a_block_join_what_all_pairs_join():
    """Links given: true ones only, no more than needed, and joining all that true pairs join."""
    r = random.Random(11)
    settings = setsketch.Settings(slack=0.8)     # registers rule nothing out here
    for _ in range(15):
        bases = [{r.randrange(10_000) for _ in range(60)} for _ in range(4)]
        sets = [{e if r.random() > 0.06 else r.randrange(10_000) for e in r.choice(bases)} for _ in range(80)]
        n = len(sets)
        component = np.array([r.randrange(n) if r.random() < 0.2 else i for i in range(n)])
        _, component = np.unique(component, return_inverse=True)
        order = np.argsort(component, kind="stable")
        whole = {"id": np.array(r.sample(range(1000), n)), "component": component[order], "row": order,
                 "n": np.array([len(sets[i]) for i in order]), "sketch": np.zeros((128, n), np.uint16)}
        part = np.array([r.random() < 0.5 for _ in range(n)])
        x, y = ({k: v[..., at] for k, v in whole.items()} for at in (part, ~part))
        links = []
        for one, two in ((x, x), (y, y), (x, y)):
            links += setsketch.links_within(one, two, _sets(sets), int(component.max()) + 1, (0, 4), settings)

        def merged(edges):
            of = {int(i): int(c) for i, c in zip(whole["id"], whole["component"], strict=True)}
            for a, b in edges:
                low, high = sorted((of[a], of[b]))
                of = {i: low if c == high else c for i, c in of.items()}
            return of

        true = {(int(min(whole["id"][i], whole["id"][j])), int(max(whole["id"][i], whole["id"][j])))
                for i in range(n) for j in range(i)
                if 100 * len(sets[order[i]] & sets[order[j]]) >= 80 * len(sets[order[i]] | sets[order[j]])}
        assert set(links) <= true and len(links) < 3 * n
        assert merged(links) == merged(true)


def test_chance_of_a_missed_pair():
    """At the threshold: no shared band, or fewer equal registers than the last step goes down to."""
    s = setsketch.Settings()
    steps = s.agreements()
    assert steps[0][1] > s.registers and all(a == d for (a, _), (_, d) in zip(steps, steps[1:], strict=False))
    j, m, least = s.percent / 100, s.registers, steps[-1][0]
    unshared = (1 - j ** s.band) ** s.bands
    unlike = sum(math.comb(m, k) * j**k * (1 - j) ** (m - k) for k in range(least))
    assert unshared < 5e-8 and unlike < 5e-7


def test_cases(spark):
    docs = documents(spark, [*TEXTS, LONG], [*range(len(TEXTS) - 1), 3, None])
    out = setsketch.near_duplicates(docs).collect()
    assert len(out) == len(TEXTS) + 1
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)
    assert all(r["component_id"] is None for r in out if r["doc_id"] is None)
    kept = setsketch.representatives(docs)
    assert kept.columns == docs.columns
    assert setsketch.near_duplicates(docs.limit(0)).collect() == []
