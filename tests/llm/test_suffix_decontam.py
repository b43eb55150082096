import hashlib
import random
import tracemalloc
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pulsewatch.llm import decontam, suffix
from pulsewatch.llm.common import byte_slices, saved
from tests.llm.cases import documents


def _removed(rows, length):
    places = defaultdict(int)
    raw = [(i, (t or "").encode()) for i, t in rows]
    for _, b in raw:
        for k in range(len(b) - length + 1):
            places[b[k:k + length]] += 1
    out = []
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if places[b[k:k + length]] > 1:
                gone[k:k + length] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + (gone[0] if len(gone) else 0))
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_suffix_order_and_common_prefixes():
    r = np.random.default_rng(2)
    for n, letters in ((300, 2), (500, 4), (200, 1)):
        data = r.integers(97, 97 + letters, n).astype(np.uint8)
        raw = data.tobytes()
        starts = r.random(n) < 0.7
        order = suffix.larsson_sadakane(data, 40, starts)
        assert sorted(order) == np.flatnonzero(starts).tolist()
        keys = [raw[i:i + 40].ljust(40, b"\0") for i in order]
        assert keys == sorted(keys)
        place, before = order[1:], order[:-1]
        by = np.argsort(place)
        limit = n - np.maximum(place, before)
        got = suffix.kasai(raw, place[by], before[by], limit[by])
        for i, j, most, common in zip(place[by], before[by], limit[by], got, strict=True):
            k = 0
            while k < most and raw[i + k] == raw[j + k]:
                k += 1
            assert common == k


def test_anchors_agree_on_equal_windows():
    r = np.random.default_rng(3)
    shared = r.integers(0, 2**63, 30, dtype=np.uint64)
    a = np.concatenate([r.integers(0, 2**63, 50, dtype=np.uint64), shared, r.integers(0, 2**63, 9, dtype=np.uint64)])
    b = np.concatenate([r.integers(0, 2**63, 3, dtype=np.uint64), shared])
    one = {int(a[i]) for i in suffix.anchors(a, 10)}
    two = {int(b[i]) for i in suffix.anchors(b, 10)}
    for i in range(21):
        least = int(shared[i:i + 10].min())
        assert least in one and least in two


@pytest.mark.parametrize(("length", "shard", "span"), [(40, 2000, 200_000), (40, 12, 300), (80, 6, 100)])
def test_removed_bytes_equal_brute_force(spark, length, shard, span):
    r = random.Random(length + shard)

    def text(n):
        return "".join(r.choice("abcdefgh éß") for _ in range(n))

    passages = [text(r.randint(length - 5, 4 * length)) for _ in range(6)]
    rows = []
    for i in range(160):
        t = text(r.randint(0, 3 * length))
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randrange(len(p) // 2)
            t += p[a:a + r.randint(length // 2, len(p))] + text(r.randint(0, 5))
        rows.append((i, t))
    rows += [(1000 + i, rows[i][1]) for i in range(12)] + [
        (2000, "a" * 300), (2001, "ab" * 200), (2002, None), (2003, ""), (None, text(100)), (2004, passages[0] * 3),
        (5, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    settings = suffix.Settings(length=length, shard_contexts=shard, range_rows=span)
    got = sorted(map(tuple, suffix.remove_repeats(df, settings).collect()), key=repr)
    assert got == _removed(rows, length)


def test_suffix_cases(spark):
    docs = documents(spark)
    rows = [(x.doc_id, x.text) for x in docs.collect()]
    got = sorted(map(tuple, suffix.remove_repeats(docs).collect()), key=repr)
    assert got == _removed(rows, 400)
    assert suffix.remove_repeats(docs.limit(0)).collect() == []


def test_steps_on_texts_take_small_batches(spark, monkeypatch):
    key, limit = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
    before, seen, held = spark.conf.get(key), [], []

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.nbytes]})

    r = random.Random(7)
    text = "".join(r.choice("abcdefgh ") for _ in range(20_000))
    rows = spark.createDataFrame([(i, text[i:]) for i in range(500)], "doc_id long, text string").coalesce(1)

    def noted(df, name):
        seen.append((name, spark.conf.get(key)))
        if name == "repeat-candidates":
            held.append(rows.mapInArrow(sizes, "n long").agg({"n": "max"}).first()[0])
        return saved(df, name)

    monkeypatch.setattr(suffix, "saved", noted)
    got = sorted(suffix.remove_repeats(rows.filter("doc_id < 20")).collect())
    assert [x.n_bytes - x.n_removed for x in got] == [1] + [0] * 19
    assert len(seen) == 5 and all(value == str(limit) for _, value in seen), seen
    assert held[0] < 1.5 * limit
    assert spark.conf.get(key) == before


def test_anchor_scan_holds_a_slice_of_hashes():
    class Plan:
        def select(self, *_):
            return self

        def mapInArrow(self, found, _):  # noqa: N802
            return found

    r = np.random.default_rng(5)
    texts = ["".join(map(chr, r.integers(97, 123, 4_000))) for _ in range(700)]
    batch = pa.RecordBatch.from_pydict({"text_key": pa.array(range(700), pa.int64()), "text": texts})
    found = suffix.anchor_table(Plan(), suffix.Settings())
    rows = sum(b.num_rows for b in found(iter([batch])))  # tables of powers are kept
    tracemalloc.start()
    assert sum(b.num_rows for b in found(iter([batch]))) == rows > 10_000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6


# --- decontamination ----------------------------------------------------------------

def _sellers(pattern, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def _mutated(r, text, edits, letters):
    out = list(text)
    for _ in range(edits):
        kind, i = r.randint(0, 2), r.randrange(len(out))
        if kind == 0:
            out[i] = r.choice(letters)
        elif kind == 1:
            del out[i]
        else:
            out.insert(i, r.choice(letters))
    return "".join(out)


def test_leaks_equal_brute_force():
    r, letters, settings = random.Random(5), "abcde ", decontam.Settings()
    items = ["".join(r.choice(letters) for _ in range(r.randint(24, 90))) for _ in range(10)]
    index = decontam.Index([([i], t.encode()) for i, t in enumerate(items)], settings)
    texts = []
    for _ in range(200):
        item = r.choice(items)
        noise = ["".join(r.choice(letters) for _ in range(r.randint(0, 50))) for _ in range(2)]
        texts.append(noise[0] + _mutated(r, item, r.randint(0, settings.edits(len(item)) + 2), letters) + noise[1])
    found = 0
    for first, end, data, offsets in byte_slices(pa.array(texts), 2000):
        leaks = index.leaks(data, offsets)
        for k in range(end - first):
            for j, item in enumerate(items):
                edits = _sellers(item, texts[first + k])
                got = leaks.get((k, j))
                assert (got[0] if got else None) == (edits if edits <= settings.edits(len(item)) else None)
                if got:
                    found += 1
                    assert _sellers(item, texts[first + k][got[1]:got[2]]) == edits
    assert found > 100


def test_the_bound_is_positive_for_every_length():
    settings = decontam.Settings()
    for m in range(settings.q, 500):
        assert m + 1 - settings.q * (settings.edits(m) + 1) >= 1


def test_short_items_occur_exactly_between_word_borders():
    import re

    r, letters = random.Random(6), "ab c"
    items = sorted({"".join(r.choice(letters) for _ in range(r.randint(1, 23))) for _ in range(40)})
    index = decontam.Index([([i], t.encode()) for i, t in enumerate(items)], decontam.Settings())
    texts = ["".join(r.choice([*letters, r.choice(items), f" {r.choice(items)} "]) for _ in range(r.randint(0, 12)))
             for _ in range(150)]
    found = 0
    for first, end, data, offsets in byte_slices(pa.array(texts), 500):
        leaks = index.leaks(data, offsets)
        for k in range(end - first):
            text = texts[first + k]
            for j, item in enumerate(items):
                places = [m.start() for m in re.finditer(f"(?={re.escape(item)})", text)]
                places = [a for a in places if not (a and text[a - 1].isalnum() and item[0].isalnum())
                          and not (a + len(item) < len(text) and text[a + len(item)].isalnum() and item[-1].isalnum())]
                want = (0, places[0], places[0] + len(item)) if places else None
                assert leaks.get((k, j)) == want, (text, item)
                found += want is not None
    assert found > 100


def test_regions_aligned_together_equal_one_by_one():
    r, letters, settings = random.Random(8), "abcd ", decontam.Settings()
    items = ["".join(r.choice(letters) for _ in range(r.randint(24, 160))) for _ in range(8)]
    index = decontam.Index([([i], t.encode()) for i, t in enumerate(items)], settings)
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 60))) + _mutated(r, r.choice(items), r.randint(0, 18), letters)
             + "".join(r.choice(letters) for _ in range(r.randint(0, 60))) for _ in range(80)]
    for _, _, data, offsets in byte_slices(pa.array(texts), 3000):
        folded = decontam.fold(data)
        row, item, low, high = index.regions(folded, offsets)
        begin, end = offsets[row], offsets[row + 1]
        got = dict(index.aligned(folded, begin, end, item, low - begin, high - begin))
        for k, i in enumerate(item.tolist()):
            e = int(index.budget[i])
            want = decontam.banded(index.texts[i], folded[begin[k]:end[k]], int(low[k] - begin[k]) - e,
                                   int(high[k] - begin[k]) + e, e)
            assert got.get(k) == want


def test_matches_blocks_and_cases(spark):
    docs = documents(spark, [None, "", "é The Quick brown fox\njumps over the lazy dog! tail", "clean words only", "x"],
                     [0, 1, 2, 3, None])
    items = [(7, "the quick brown fox jumps over the lazy dog!"), (8, None), (9, "short"),
             (7, "the quick brown fox jumps over the lazy dog!"), (5, "another benchmark passage of some length")]
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, leaks int")
    for settings in (decontam.Settings(), decontam.Settings(block_bytes=10), decontam.Settings(block_bytes=10, scan_blocks=1)):
        got = decontam.matches(docs, benchmark, settings).collect()
        assert {(r["doc_id"], r["item_id"], r["edits"], r["start"], r["end"]) for r in got} == {(2, 7, 0, 2, 46)}
        clean = decontam.without_leaks(docs, benchmark, settings)
        assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {0, 1, 3, None}
    assert decontam.matches(docs, benchmark.limit(0)).collect() == []
    assert decontam.matches(docs.limit(0), benchmark).collect() == []


# --- identities --------------------------------------------------------------------------

def test_two_hashes_tell_windows_apart_where_one_collides():
    """Rows whose first hash is forced to collide repeat only if the second agrees too."""
    empty = [[0]] * 6
    rows = pa.table({
        "g": pa.array([1] * 6), "ctx": pa.array([b"c"] * 6, pa.binary()), "open": [True] * 6,
        "w": pa.array([7, 7, 7, 7, 9, 9]), "w2": pa.array([1, 2, 2, 3, 4, 4]), "place": pa.array([10, 20, 30, 40, 50, 50]),
        "begin": pa.array(empty, pa.list_(pa.int32())), "finish": pa.array(empty, pa.list_(pa.int32()))})
    # 7/1 and 7/3 occur once, 9/4 at one place only.
    assert suffix._merge_range(rows).column("place").to_pylist() == [20, 30]


def test_context_identities_are_independent():
    import numpy as np

    from pulsewatch.llm.common import BYTE_CODES, prefix_hash, span_hash

    r = np.random.default_rng(3)
    data = r.integers(97, 100, 5000, dtype=np.uint8)
    start = np.arange(0, 4990)
    one, two = (span_hash(prefix_hash(codes[data]), start, start + 8) for codes in (BYTE_CODES, suffix.SECOND_CODES))
    joint = suffix._joint(one, two)
    assert joint.type == pa.binary() and len(joint[0].as_py()) == 16
    texts = [data[a:a + 8].tobytes() for a in start]
    assert len(set(joint.to_pylist())) == len(set(texts)) == len(set(zip(one.tolist(), two.tolist(), strict=True)))
    assert not (one == two).any()
