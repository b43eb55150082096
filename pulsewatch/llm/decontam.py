"""Benchmark decontamination by the q-gram lemma.

An item of ``m`` bytes that occurs in a text with at most ``e`` edits shares
at least ``m + 1 - q * (e + 1)`` of its q-grams with the occurrence, on
diagonals (text position minus item position) that differ by at most ``e``.
So: look up every q-gram of the text in the items' index, count hits per item
in diagonal bands of ``2 * (e + 1)`` that overlap by half, keep the regions
whose count meets the bound, and verify each by banded alignment, which gives
the exact edit distance and the place.

Neighbouring bands of one text and item are verified as one region, and all regions
of a slice of texts are aligned together, a pattern byte at a time.

The q-gram index is broadcast in blocks of at most ``block_bytes`` of item
text, read from the benchmark table block by block. Up to ``scan_blocks`` blocks are looked up
in one scan of the documents; a larger benchmark takes further scans, so neither the
driver nor a worker ever holds more than those. Documents are never shuffled or collected.

The edit budget is a tenth of an item's bytes, less where the lemma's bound would reach zero. Items shorter
than ``min_bytes`` must occur exactly and between word borders; those shorter than
``q`` are looked up as one gram of their own length. Of an item's occurrences in a text
the best is reported: the fewest edits, then the first.

Bytes are compared with A-Z lower-cased and each ASCII white-space byte read
as a space. Cases: null or empty texts have no leaks; null and empty items find
nothing; equal items are reported under each of their
ids; an empty benchmark finds nothing; a repeated document row is reported
for each row. Existing columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, saved, text_or_empty


@dataclass(frozen=True)
class Settings:
    q: int = 8
    edit_rate: float = 0.1
    min_bytes: int = 24
    block_bytes: int = 4_000_000
    scan_blocks: int = 8

    def edits(self, m: int) -> int:
        """Edit budget of an item of ``m`` bytes (the bound stays at least 1)."""
        return 0 if m < max(self.min_bytes, self.q) else max(0, min(int(self.edit_rate * m), (m + 1) // self.q - 1 - ((m + 1) % self.q == 0)))


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A"):ord("Z") + 1] += 32
_FOLD[0x09:0x0E] = 0x20


def fold(data: np.ndarray) -> np.ndarray:
    return _FOLD[data]


def grams(data: np.ndarray, q: int) -> np.ndarray:
    """The q-gram at each position as one 64-bit number (q at most 8: exact)."""
    n = len(data) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(q):
        out = (out << np.uint64(8)) | data[i:i + n]
    return out


class Index:
    """Sorted q-grams of a block of items."""

    FILTER_BITS = 22

    def __init__(self, items: list[tuple[list, bytes]], settings: Settings):
        if not 1 <= settings.q <= 8:
            raise ValueError("q must be 1 to 8")
        self.settings = settings
        self.ids = [ids for ids, _ in items]
        self.texts = [fold(np.frombuffer(text, np.uint8)) for _, text in items]
        self.length = np.array([len(t) for t in self.texts], np.int64)
        self.budget = np.array([settings.edits(int(m)) for m in self.length], np.int64)
        self.bound = self.length + 1 - settings.q * (self.budget + 1)
        # Items shorter than a q-gram are found by a gram of their own length.
        self.short: dict[int, list[int]] = {}
        for i, m in enumerate(self.length.tolist()):
            if 0 < m < settings.q:
                self.short.setdefault(m, []).append(i)
        keys = [grams(t, settings.q) for t in self.texts]
        every = np.concatenate([*keys, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(items)), [len(k) for k in keys])
        place = np.concatenate([*(np.arange(len(k)) for k in keys), np.zeros(0, np.int64)])
        order = np.argsort(every, kind="stable")
        self.item, self.place = item[order].astype(np.int32), place[order].astype(np.int32)
        self.keys, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)
        self.seen = np.zeros(1 << self.FILTER_BITS, bool)
        self.seen[self._slot(self.keys)] = True

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.FILTER_BITS)

    # -- filter ---------------------------------------------------------------
    def regions(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, first diagonal, end diagonal) of the runs of bands that meet the bound."""
        none = tuple(np.zeros((4, 0), np.int64))
        q = self.settings.q
        text_grams = grams(data, q)
        if not len(text_grams) or not len(self.keys):
            return none
        at = np.flatnonzero(self.seen[self._slot(text_grams)])
        found = np.minimum(np.searchsorted(self.keys, text_grams[at]), len(self.keys) - 1)
        real = self.keys[found] == text_grams[at]
        at, found = at[real], found[real]
        row = np.searchsorted(offsets, at, "right") - 1
        inside = at + q <= offsets[row + 1]
        at, found, row = at[inside], found[inside], row[inside]
        count = self.count[found]
        ends = np.cumsum(count)
        if not len(ends):
            return none
        source = np.arange(int(ends[-1])) + np.repeat(self.first[found] - (ends - count), count)
        item, row = self.item[source].astype(np.int64), np.repeat(row, count)
        shift = int(self.length.max()) + 1  # keeps diagonals positive
        diagonal = np.repeat(at, count) - self.place[source] + shift
        width = self.budget[item] + 1
        block = diagonal // width
        blocks = int(block.max()) + 2
        keys, counts = np.unique((row * len(self.ids) + item) * blocks + block, return_counts=True)
        follows = np.zeros(len(keys), np.int64)
        next_to = np.flatnonzero(keys[1:] == keys[:-1] + 1)
        follows[next_to] = counts[next_to + 1]
        pair, block = keys // blocks, keys % blocks
        item = pair % len(self.ids)
        # The band of blocks b and b + 1 is seen from b; that of b - 1 and b too, where b - 1 is empty it adds nothing.
        kept = np.flatnonzero(counts + follows >= self.bound[item])
        if not len(kept):
            return none
        # Kept bands that follow one another share a block: one region.
        fresh = np.flatnonzero(np.diff(keys[kept], prepend=-2) != 1)
        first, last = kept[fresh], kept[np.append(fresh[1:], len(kept)) - 1]
        width = self.budget[item[first]] + 1
        return (pair[first] // len(self.ids), item[first], block[first] * width - shift,
                (block[last] + 2) * width - shift)

    # -- verification --------------------------------------------------------------
    def exact(self, text: np.ndarray, item: int, low: int, high: int) -> tuple[int, int, int] | None:
        """(0, start, end) of the first exact occurrence on diagonals [low - e, high + e)."""
        pattern, e = self.texts[item], int(self.budget[item])
        first = max(0, low - e)
        window = text[first:high + 2 * e + len(pattern)].tobytes()
        wanted, at = pattern.tobytes(), -1
        while (at := window.find(wanted, at + 1)) >= 0:
            place = (first + at, first + at + len(pattern))
            if len(pattern) >= self.settings.min_bytes or _bordered(text, *place):
                return 0, *place
        return None

    def short_leaks(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(row, item, start, end) of items shorter than a q-gram, between word borders."""
        for size, items in self.short.items():
            text_grams = grams(data, size)
            wanted = np.concatenate([grams(self.texts[i], size) for i in items])
            at = np.flatnonzero(np.isin(text_grams, wanted))
            for place, row in zip(at.tolist(), (np.searchsorted(offsets, at, "right") - 1).tolist(), strict=True):
                start, end = int(offsets[row]), int(offsets[row + 1])
                if place + size <= end and _bordered(data[start:end], place - start, place - start + size):
                    for i, gram in zip(items, wanted.tolist(), strict=True):
                        if gram == int(text_grams[place]):
                            yield row, i, place - start, place - start + size

    def leaks(self, data: np.ndarray, offsets: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int]]:
        """Best (edits, start, end) in bytes of the row, by (row, item)."""
        folded = fold(data)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        row, item, low, high = self.regions(folded, offsets)
        begin, end = offsets[row], offsets[row + 1]
        low, high = low - begin, high - begin
        open_ = []
        for k, (r, i, a, z) in enumerate(zip(row.tolist(), item.tolist(), low.tolist(), high.tolist(), strict=True)):
            hit = self.exact(folded[begin[k]:end[k]], i, a, z)
            if hit is None:
                open_.append(k)
            elif (r, i) not in best or hit < best[r, i]:
                best[r, i] = hit
        left = np.array([k for k in open_ if (int(row[k]), int(item[k])) not in best and self.budget[item[k]] > 0], np.int64)
        for k, hit in self.aligned(folded, begin[left], end[left], item[left], low[left], high[left]):
            pair = int(row[left[k]]), int(item[left[k]])
            if pair not in best or hit < best[pair]:
                best[pair] = hit
        for r, i, a, z in self.short_leaks(folded, offsets):
            if (r, i) not in best or (0, a, z) < best[r, i]:
                best[r, i] = (0, a, z)
        return best

    def aligned(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray, item: np.ndarray, low: np.ndarray,
                high: np.ndarray) -> Iterator[tuple[int, tuple[int, int, int]]]:
        """(region, best place) of the regions within their budget, as :func:`banded` finds them.

        Regions of like width are aligned side by side, at most :data:`CELLS` cells at a time.
        """
        e = self.budget[item]
        low, width = low - e, high - low + 2 * e
        order = np.argsort(width, kind="stable")
        at = 0
        while at < len(order):
            count = 1 + int(np.searchsorted(np.cumsum(np.maximum.accumulate(width[order[at + 1:]])) + width[order[at]], CELLS))
            group = order[at:at + count]
            at += count
            yield from self._aligned(data, begin[group], end[group] - begin[group], item[group], low[group], width[group], group)

    def _aligned(self, data: np.ndarray, begin: np.ndarray, n: np.ndarray, item: np.ndarray, low: np.ndarray,
                 width: np.ndarray, number: np.ndarray) -> Iterator[tuple[int, tuple[int, int, int]]]:
        m, budget = self.length[item], self.budget[item]
        patterns = np.full((len(item), int(m.max())), 0xFF, np.uint8)  # no byte of a text
        for k, i in enumerate(item.tolist()):
            patterns[k, :m[k]] = self.texts[i]
        unit = np.int64(1) << 40
        far = unit * np.int64(int(n.max()) + int(m.max()) + 2)
        lane = np.arange(int(width.max()), dtype=np.int64)
        start = lane + low[:, None]
        cells = np.where((start >= 0) & (start <= n[:, None]) & (lane < width[:, None]), start, far)
        for i in range(1, patterns.shape[1] + 1):
            column = start + i
            inside = (column >= 1) & (column <= n[:, None])
            letters = data[np.where(inside, column - 1 + begin[:, None], 0)]
            step = np.where(inside, cells + unit * (letters != patterns[:, i - 1:i]), far)
            skip = np.full_like(cells, far)
            skip[:, :-1] = cells[:, 1:] + unit
            step = np.minimum(step, np.where((column >= 0) & (column <= n[:, None]), skip, far))
            cells = np.minimum.accumulate(step - lane * unit, axis=1) + lane * unit
            cells[(column < 0) | (column > n[:, None]) | (lane >= width[:, None])] = far
            least = cells.min(axis=1)
            alive = least < (budget + 1) * unit
            for k in np.flatnonzero(alive & (m == i)):
                place = int(np.argmin(cells[k]))
                value = int(cells[k, place])
                yield int(number[k]), (value >> 40, value & ((1 << 40) - 1), int(start[k, place]) + i)
            alive &= m > i
            if not alive.any():
                return
            if alive.sum() * 4 <= len(alive) * 3:
                cells, start, patterns = cells[alive], start[alive], patterns[alive]
                begin, n, m, budget, width, number = (x[alive] for x in (begin, n, m, budget, width, number))
            else:
                cells[~alive] = far


# Cells that are aligned at once.
CELLS = 1 << 17
_WORD_BYTE = np.array([i >= 128 or chr(i).isalnum() for i in range(256)])


def _bordered(text: np.ndarray, start: int, end: int) -> bool:
    """Whether the span neither begins nor ends inside a word."""
    return not ((start > 0 and _WORD_BYTE[text[start - 1]] and _WORD_BYTE[text[start]])
                or (end < len(text) and _WORD_BYTE[text[end]] and _WORD_BYTE[text[end - 1]]))


def banded(pattern: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """Best place of ``pattern`` in ``text`` with at most ``budget`` edits.

    Alignment cells are limited to diagonals [low, high); a cell holds
    edits and start in one number, so the least number is the answer.
    """
    n, m, width = len(text), len(pattern), high - low
    unit = np.int64(1) << 40
    far = unit * np.int64(m + n + 2)
    lane = np.arange(width, dtype=np.int64)
    start = lane + low  # row 0: a match may start anywhere in the band, at no cost
    cells = np.where((start >= 0) & (start <= n), start, far)
    for i in range(1, m + 1):
        column = start + i  # text end of the cell in this row
        inside = (column >= 1) & (column <= n)
        letters = np.full(width, -1, np.int16)
        letters[inside] = text[column[inside] - 1]
        step = np.where(inside, cells + unit * (letters != pattern[i - 1]), far)
        skip = np.append(cells[1:], far) + unit  # pattern byte left out
        step = np.minimum(step, np.where((column >= 0) & (column <= n), skip, far))
        cells = np.minimum.accumulate(step - lane * unit) + lane * unit  # text byte left out
        cells[(column < 0) | (column > n)] = far
        if cells.min() >= (budget + 1) * unit:
            return None
    best = int(np.argmin(cells))
    value = int(cells[best])
    edits = value >> 40
    return (edits, value & ((1 << 40) - 1), int(start[best]) + m) if edits <= budget else None


# --- Spark -----------------------------------------------------------------------------

_LEAK = pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
_LEAKS = "array<struct<item_id:bigint,edits:int,start:bigint,end:bigint>>"


def item_blocks(benchmark: DataFrame, settings: Settings) -> Iterator[list[tuple[list, bytes]]]:
    """Distinct items with their ids, in blocks of bounded bytes, streamed from the table."""
    rows = (benchmark.filter(F.octet_length("text") > 0)
            .groupBy("text").agg(F.array_sort(F.collect_list(F.col("item_id").cast("long"))).alias("ids"))
            .orderBy("text"))
    block, size = [], 0
    for row in rows.toLocalIterator():
        item = row["text"].encode()
        if block and size + len(item) > settings.block_bytes:
            yield block
            block, size = [], 0
        block.append((row["ids"], item))
        size += len(item)
    if block:
        yield block


def _finder(shared):  # noqa: ANN001, ANN202 - a broadcast block
    @F.arrow_udf(_LEAKS)
    def leaks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = Index(*shared.value)
        for texts in batches:
            out: list[list] = [[] for _ in range(len(texts))]
            for first, _, data, offsets in byte_slices(texts):
                for (row, item), (edits, start, end) in index.leaks(data, offsets).items():
                    raw = data[offsets[row]:offsets[row] + end]
                    points = np.cumsum((raw & 0xC0) != 0x80)  # code points up to each byte
                    place = (int(points[start - 1]) if start else 0, int(points[end - 1]) if end else 0)
                    out[first + row] += [(i, edits, *place) for i in index.ids[item]]
            yield pa.array([[dict(zip(("item_id", "edits", "start", "end"), x, strict=True)) for x in sorted(
                found, key=lambda x: (x[2], x[0] is None, x[0]))] for found in out], pa.list_(_LEAK))

    # Else the filter that a generator infers would run the function a second time.
    return leaks.asNondeterministic()


def find_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with ``leaks``: item, edits and code-point span of each benchmark item found."""
    context = docs.sparkSession.sparkContext
    blocks = item_blocks(benchmark, settings)
    found = docs.withColumn("leaks", F.array().cast(_LEAKS))
    held: list = []
    while group := list(islice(blocks, settings.scan_blocks)):
        if held:  # what the scan before found is on file: its blocks can go
            found = saved(found, "leaks")
            for old in held:
                old.destroy()
        held = [context.broadcast((block, settings)) for block in group]
        finders = [_finder(block)(text_or_empty("text")) for block in held]
        found = found.withColumn("leaks", F.concat("leaks", *finders))
    return found


def matches(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document row and benchmark item found in it."""
    return (find_leaks(docs.select("doc_id", "text"), benchmark, settings)
            .select("doc_id", F.inline("leaks")))


def without_leaks(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents in which no benchmark item was found, columns unchanged."""
    columns = docs.columns
    return find_leaks(docs, benchmark, settings).filter(F.size("leaks") == 0).select(*columns)
