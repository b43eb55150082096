import hashlib

import numpy as np
import pytest

from pulsewatch.llm import codebooks, spectrum, whitening
from pulsewatch.llm.common import table
from pulsewatch.llm.vectors import dimension

SMALL = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def _frame(spark, rows):
    """(vec_id, embedding, label) rows with extra columns that clash with output names."""
    return spark.createDataFrame(
        [(*r, "clash", 1.5, None) for r in rows],
        "vec_id long, embedding array<float>, label int, code string, whitened double, n long")


def _awkward(spark, size=4):
    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.normal(0, 0.3, size)], i % 3 or None) for i in range(40)]
    rows += [(100, None, 1), (101, [None] * size, 1), (102, [NAN] + [0.0] * (size - 1), 1), (103, [INF] * size, 2),
             (104, [0.0], 1), (105, [], 1), (3, [9.0] * size, 1), (None, [-9.0] * size, None), (107, [1e30] * size, 2)]
    rows += [(200 + i, [0.25] * size, 7) for i in range(30)]
    return rows


def _usable(rows, size):
    return [r for r in rows if r[1] is not None and len(r[1]) == size and None not in r[1] and np.isfinite(r[1]).all()]


# --- spectrum -----------------------------------------------------------------------

def test_inertia_counts_signs():
    r = np.random.default_rng(1)
    for _ in range(300):
        n = int(r.integers(1, 12))
        a = r.standard_normal((n, n))
        a = a + a.T
        if r.random() < 0.5:
            np.fill_diagonal(a, 0)
        w = np.linalg.eigvalsh(a)
        assert spectrum.inertia(a) == ((w > 1e-12).sum(), (abs(w) <= 1e-12).sum(), (w < -1e-12).sum())


@pytest.mark.parametrize("values", [[1.0], [5, 5, 5, 1, 1, 0, 0], [0, 0, 0], [1, 1 + 1e-13, 1 + 2e-15, 0.5, 1e-9],
                                    [4.0] * 7 + [3, 3, 2.9999999] + [1.0] * 20])
def test_known_spectra(values):
    n = len(values)
    q = np.linalg.qr(np.random.default_rng(2).standard_normal((n, n)))[0]
    a = q @ np.diag(np.array(values, float)) @ q.T
    a = (a + a.T) / 2
    e, u = spectrum.leading(a, 16)
    want = sorted((v for v in values if v), reverse=True)[:16]
    assert np.allclose(e, want, rtol=0, atol=1e-13 * max(values + [1]))
    assert np.allclose(u.T @ u, np.eye(len(want)), atol=1e-13)
    assert np.allclose(a @ u, u * e, atol=1e-12)


def test_spectra_equal_the_library():
    r = np.random.default_rng(4)
    for _ in range(150):
        n, m = int(r.integers(1, 20)), int(r.integers(1, 25))
        x = r.integers(-3, 4, (m, n)).astype(float)
        v = x.T @ x / m
        e, u = spectrum.leading(v, 16)
        w = np.linalg.eigvalsh(v)[::-1]
        k = min(16, (w > 1e-9).sum())
        assert len(e) == k and np.allclose(e, w[:k], rtol=1e-12)
        assert np.allclose(v @ u, u * e, atol=1e-11) and np.allclose(u.T @ u, np.eye(k), atol=1e-12)


# --- whitening ----------------------------------------------------------------------

def _white_reference(rows, size):
    kept = _usable(rows, size)
    x = np.clip(np.floor(64 * np.array([np.float32(r[1]) for r in kept], np.float64)), -2.0 ** 40, 2.0 ** 40).astype(np.int64)
    x += 1_000_000
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    v = np.cov(fit.T.astype(float), bias=True).reshape(size, size)
    e, q = np.linalg.eigh(v)
    return kept, x, n, sums, e[::-1], q[:, ::-1], np.trace(v)


def _check_whitening(df, rows, size):
    kept, x, n, sums, e, q, trace = _white_reference(rows, size)
    k = min(16, int((e > 1e-9 * e[0]).sum()))
    out = df.collect()
    assert len(out) == len(kept) * k
    by_component = {c: [r for r in out if r["component"] == c] for c in range(1, k + 1)}
    for c in range(1, k + 1):
        want = {}
        for r, row in zip(kept, x, strict=True):
            dev = sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums, strict=True))
            projected = float((row - sums / n) @ q[:, c - 1] / np.sqrt(e[c - 1]))
            want.setdefault(r[0], []).append((dev if dev < 2 ** 63 else None, abs(projected)))
        got = {}
        for r in by_component[c]:
            got.setdefault(r["vec_id"], []).append((r["deviation"], abs(r["whitened"])))
            assert r["n"] == n and abs(r["explained"] - e[c - 1] / trace) <= 1e-9 and r["identity_error"] <= 1e-9
        assert got.keys() == want.keys()
        for key in want:
            for g, w in zip(sorted(got[key], key=repr), sorted(want[key], key=repr), strict=True):
                assert g[0] == w[0] and abs(g[1] - w[1]) < 1e-6 * max(1, w[1])
        signs = {np.sign(r["whitened"]) for r in by_component[c]}
        assert signs - {0.0}


def test_whitening_on_the_table(spark):
    rows = table(spark, SMALL, "embeddings")
    _check_whitening(whitening.whitening(rows), [tuple(r) for r in rows.select("vec_id", "embedding").collect()], 64)


def test_whitening_cases(spark):
    rows = [r for r in _awkward(spark) if r[0] != 107]
    _check_whitening(whitening.whitening(_frame(spark, rows).repartition(5)), rows, 4)
    empty = _frame(spark, rows).limit(0)
    out = whitening.whitening(empty)
    assert out.collect() == [] and out.columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    # One distinct vector, and vectors on a line.
    assert whitening.whitening(_frame(spark, [(i, [1.0, 2.0], 0) for i in range(5)])).collect() == []
    line = whitening.whitening(_frame(spark, [(i, [float(i), 2.0 * i], 0) for i in range(9)])).collect()
    assert {r["component"] for r in line} == {1} and len(line) == 9
    assert dimension(_frame(spark, rows), "embedding") == 4
    # Saturated entries and a deviation beyond a long do not fail.
    huge = whitening.whitening(_frame(spark, [(0, [1e30, 0.0], 1), (1, [0.0, 0.0], 1), (2, [-1e30, 1.0], 1)])).collect()
    assert {r["deviation"] for r in huge if r["vec_id"] == 0} == {None}


def test_packing_is_canonical():
    x = np.array([[1, 2], [-128, 127], [128, 0], [1 << 20, -5], [-(1 << 40), 3]])
    packed = whitening.pack(x)
    assert [len(p) for p in packed] == [2, 2, 4, 8, 16]
    import pyarrow as pa

    back = whitening.unpack(pa.array(packed, pa.binary()), 2)
    assert sorted(map(tuple, back.tolist())) == sorted(map(tuple, x.tolist()))


# --- codebooks ------------------------------------------------------------------------

def _lloyd(rows, size, parts=16, entries=64, rounds=2):
    """Plain Lloyd rounds over all rows at once."""
    kept = _usable(rows, size)
    x = np.clip(np.floor(256 * np.array([np.float32(r[1]) for r in kept], np.float64)), -2 ** 24, 2 ** 24).astype(np.int64)
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, list(np.float32(kept[i][1]))))
    cuts = codebooks.cuts_of(size, parts)
    books = [x[order[:entries], a:b].copy() for a, b in zip(cuts, cuts[1:], strict=False)]

    def assign():
        d = [((x[:, None, a:b] - book[None]) ** 2).sum(2) for a, b, book in zip(cuts, cuts[1:], books, strict=False)]
        return [m.argmin(1) for m in d], sum(m.min(1) for m in d)

    for _ in range(rounds):
        nearest, _ = assign()
        for p, book in enumerate(books):
            for e in range(len(book)):
                own = x[nearest[p] == e, cuts[p]:cuts[p + 1]]
                if len(own):
                    book[e] = own.sum(0) // len(own)
    nearest, error = assign()
    labels = {}
    for r, e in zip(kept, error, strict=True):
        labels[r[2]] = labels.get(r[2], 0) + int(e)
    sha = hashlib.sha256(",".join(str(v) for b in books for v in b.reshape(-1)).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{a[i]:02x}" for a in nearest), int(error[i]), labels[r[2]], sha)
                   for i, r in enumerate(kept)), key=repr)


def _rows_of(df):
    return sorted(((r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in df.collect()),
                  key=repr)


@pytest.mark.parametrize("size", [32, 4, 37])
def test_codebooks_equal_plain_lloyd(spark, size):
    rows = _awkward(spark, size)
    df = _frame(spark, rows).repartition(6)
    assert _rows_of(codebooks.compress(df)) == _lloyd(rows, size)
    few = codebooks.Settings(parts=2, entries=5, rounds=4)
    assert _rows_of(codebooks.compress(df, settings=few)) == _lloyd(rows, size, 2, 5, 4)
    salted = codebooks.Settings(parts=2, entries=5, rounds=0, broadcast_labels=0)
    assert _rows_of(codebooks.compress(df, settings=salted)) == _lloyd(rows, size, 2, 5, 0)


def test_codebooks_without_rows(spark):
    empty = _frame(spark, _awkward(spark)).limit(0)
    out = codebooks.compress(empty)
    assert out.collect() == []
    assert {"vec_id", "code", "error", "label_error", "codebooks_sha256"} <= set(out.columns)


def test_only_parts_that_change_entry_migrate(spark):
    rows = table(spark, SMALL, "embeddings")
    first = codebooks.first_codebooks(rows, "vec_id", "embedding", 64, codebooks.Settings())
    settled = codebooks._settle(codebooks._arrivals(rows, "vec_id", "embedding", first, 1), "test-members")
    after = codebooks._updated([settled], [first])

    def members(blocks):
        out = {}
        for r in blocks.collect():
            cut = first.cuts[r["position"] + 1] - first.cuts[r["position"]]
            values = np.frombuffer(r["members"], f"<i{r['width']}").reshape(-1, cut)
            for key, value in zip(np.frombuffer(r["keys"], np.uint32), values.astype(np.int64), strict=True):
                out[r["position"], int(key)] = r["entry"], value
        return out

    before, moved = members(settled), members(codebooks._leavers([settled], [first, after], 1))
    assert len(before) == 16 * rows.count()
    changed = {k: int(codebooks.nearest(v[None], after.entries[k[0]])[0][0]) for k, (e, v) in before.items()}
    assert {k: e for k, (e, _) in moved.items()} == {k: e for k, e in changed.items() if e != before[k][0]}
    assert 0 < len(moved) < len(before) / 2


def test_nearest_ties_and_large_values():
    book = np.array([[5, 5], [1, 1], [1, 1], [-3, 0]])
    entry, error = codebooks.nearest(np.array([[1, 1], [3, 3], [-3, 1]]), book)
    assert entry.tolist() == [1, 0, 3] and error.tolist() == [0, 8, 1]
    big = codebooks.LIMIT
    wide = np.full((3, 40), big)
    entry, error = codebooks.nearest(wide, np.array([[-big] * 40, [big] * 40]))
    assert entry.tolist() == [1, 1, 1] and error.tolist() == [0, 0, 0]
