"""Leading eigenpairs of a symmetric matrix by spectrum slicing.

The inertia of ``A - s I`` (Sylvester: an LDL' factorisation keeps the signs of
the eigenvalues) counts the eigenvalues above any shift s. Slicing an interval at
its middle by such counts isolates each of the leading eigenvalues in a slice
of its own; Rayleigh quotient iteration, cubic near a solution, then
finds the pair, and two counts on either side of the found value certify its number.
Eigenvalues that no slice of rounding width can part form a cluster, whose
subspace is found by inverse iteration on a block.

The matrices are covariances of one row per dimension: they are small, and
nothing here depends on the number of vectors.
"""

from __future__ import annotations

import numpy as np

_ALPHA = (1 + np.sqrt(17)) / 8  # bounds the growth of a pivoted LDL' (Bunch and Parlett)
EPS = float(np.finfo(float).eps)


def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """(positive, zero, negative) eigenvalues, by LDL' with complete diagonal pivoting.

    Pivot blocks are 1 x 1 or 2 x 2; a 2 x 2 block is only taken where its
    determinant is negative, so it has one eigenvalue of each sign.
    """
    a = np.array(matrix, float)
    n = len(a)
    positive = zero = negative = 0
    tiny = np.abs(a).max(initial=0.0) * EPS * 1e-3
    k = 0
    while k < n:
        rest = a[k:, k:]
        diagonal = np.abs(np.diagonal(rest))
        d = int(diagonal.argmax())
        off = np.abs(np.tril(rest, -1))
        o = int(off.argmax())
        i, j = divmod(o, n - k)
        if max(diagonal[d], off[i, j]) <= tiny:
            zero += n - k
            break
        if diagonal[d] >= _ALPHA * off[i, j]:
            order = [d]
        else:
            order = [j, i]
        for place, chosen in enumerate(order):
            p, q = k + place, k + chosen
            if p != q:
                a[[p, q]] = a[[q, p]]
                a[:, [p, q]] = a[:, [q, p]]
        size = len(order)
        block = a[k:k + size, k:k + size]
        if size == 1:
            positive, negative = positive + int(block[0, 0] > 0), negative + int(block[0, 0] < 0)
        else:
            positive, negative = positive + 1, negative + 1
        below = a[k + size:, k:k + size]
        a[k + size:, k + size:] -= below @ np.linalg.solve(block, below.T)
        k += size
    return positive, zero, negative


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are greater than ``shift``."""
    return inertia(matrix - shift * np.eye(len(matrix)))[0]


def _solve(matrix: np.ndarray, shift: float, right: np.ndarray, scale: float) -> np.ndarray:
    """(matrix - shift I) x = right; a shift on an eigenvalue is moved by a rounding step."""
    for step in (0.0, 4.0, 64.0):
        try:
            x = np.linalg.solve(matrix - (shift + step * EPS * scale) * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(x).all() and np.abs(x).max() > 0:
            return x
    return right


def _project(x: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """``x`` without its parts along the found vectors."""
    for _ in range(2):
        for u in found:
            x = x - np.outer(u, u @ x) if x.ndim == 2 else x - u * (u @ x)
    return x


def _rayleigh(matrix: np.ndarray, low: float, high: float, scale: float, found: list[np.ndarray],
              start: np.ndarray) -> tuple[float, np.ndarray] | None:
    """The eigenpair in (low, high] by inverse, then Rayleigh quotient iteration; None if it leaves the slice."""
    x = _project(start, found)
    x = x / np.linalg.norm(x)
    for _ in range(2):
        x = _project(_solve(matrix, (low + high) / 2, x, scale), found)
        x = x / np.linalg.norm(x)
    value = float(x @ matrix @ x)
    best = np.inf
    for _ in range(30):
        residual = float(np.linalg.norm(matrix @ x - value * x))
        if residual <= 8 * EPS * scale or residual >= best / 2 and best <= 1e-10 * scale:
            break
        best = min(best, residual)
        x = _project(_solve(matrix, value, x, scale), found)
        x = x / np.linalg.norm(x)
        value = float(x @ matrix @ x)
    slack = 64 * EPS * scale
    if residual > 1e-10 * scale or not low - slack <= value <= high + slack:
        return None
    return value, x


def _cluster(matrix: np.ndarray, middle: float, size: int, scale: float, found: list[np.ndarray],
             start: np.ndarray) -> list[tuple[float, np.ndarray]]:
    """The pairs of ``size`` eigenvalues that rounding cannot part, by block inverse iteration."""
    block = start
    for _ in range(4):
        block = np.linalg.qr(_project(_solve(matrix, middle, block, scale), found))[0]
    values, turn = np.linalg.eigh(block.T @ matrix @ block)
    block = block @ turn
    return [(float(values[i]), block[:, i]) for i in range(size - 1, -1, -1)]


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` greatest eigenvalues, falling, and their unit vectors as columns.

    Fewer where the matrix has a smaller rank: eigenvalues that are zero up to rounding are left out.
    """
    n = len(matrix)
    scale = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    if not n or scale == 0.0:
        return np.zeros(0), np.zeros((n, 0))
    random = np.random.Generator(np.random.PCG64(11))
    floor = 4 * n * EPS * scale
    narrow = 8 * n * EPS * scale
    count = min(count, count_above(matrix, floor))
    values: list[float] = []
    vectors: list[np.ndarray] = []
    # Slices (low, high] with the number of eigenvalues above either end; the highest is worked on first.
    slices = [(floor, scale * (1 + 4 * EPS), count_above(matrix, floor), 0)]
    while slices and len(values) < count:
        low, high, above_low, above_high = slices.pop()
        inside = above_low - above_high
        if inside <= 0:
            continue
        if high - low <= narrow:
            pairs = _cluster(matrix, (low + high) / 2, inside, scale, vectors, random.standard_normal((n, inside)))
        else:
            pair = None
            if inside == 1:
                pair = _rayleigh(matrix, low, high, scale, vectors, random.standard_normal(n))
            # Certificate: exactly this many eigenvalues lie above either side of the found value.
            if pair is None or (count_above(matrix, pair[0] + narrow) > above_high
                                or count_above(matrix, pair[0] - narrow) <= above_high):
                middle = (low + high) / 2
                above = min(max(count_above(matrix, middle), above_high), above_low)
                slices += [(low, middle, above_low, above), (middle, high, above, above_high)]
                continue
            pairs = [pair]
        for value, vector in pairs:
            values.append(value)
            vectors.append(vector)
    return np.array(values[:count]), np.array(vectors[:count]).reshape(-1, n).T
