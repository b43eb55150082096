"""Cost-balanced packing of token sequences.

A sequence of pieces costs ``linear * n + quadratic * n * n`` per piece: attention
within a piece grows with the square of its length. Documents are
tokenized, cut where needed and laid into sequences of ``capacity`` tokens:

* full stretches of ``capacity`` tokens of a long document fill a sequence each;
* the rests of a block of documents are assigned in descending length, each
  to the lowest-cost sequence of the block that has room. A rest that does not
  fit is cut at the free room, and the remainder is assigned again. The
  block opens as many sequences as its tokens need, so that all but the
  last of them end up full.

A block is at most ``block_tokens`` of rests from one task, so memory does
not grow with the table, nothing is shuffled, and padding is less than one
sequence a block. Sequence ids hold the partition and a running number,
so a task that is run again gives the same pieces.

Tokens are those of the ``tokenizers`` library. For speed a slice of texts is
split into pre-tokens with numpy (the vocabulary's public splitting pattern),
every distinct pre-token is encoded once (by ``tiktoken`` over the same
vocabulary file where its ids follow the merge order, which makes the two
libraries agree, else by ``tokenizers``), and its ids are gathered. A text
that holds an apostrophe (contractions) or a special token's string goes
through ``tokenizers`` whole.

Cases: a null or empty text is the end id alone. Documents with null ids are
packed like others. Repeated rows are separate documents. No token is dropped.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import BASE_INVERSE, SLICE_BYTES, U64, batch_of, mix, powers, prefix_hash, utf8_parts

# The public splitting pattern's letter, number and space classes.
_CLASS_PATTERNS = (r"\p{L}", r"\p{N}", r"\s")
LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
CODE_POINTS = 0x110000


@dataclass(frozen=True)
class Settings:
    tokenizer: str
    capacity: int = 1024
    end_id: int = 0
    linear: float = 1.0
    quadratic: float = 1.0 / 1024
    block_tokens: int = 4_000_000


# --- tokens ----------------------------------------------------------------------

def _classes() -> np.ndarray:
    """Class of every code point, by the pattern engine itself."""
    out = np.full(CODE_POINTS, OTHER, np.uint8)
    every = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, CODE_POINTS)))
    for kind, pattern in enumerate(_CLASS_PATTERNS):
        for run in regex.finditer(f"{pattern}+", every):
            first, last = ord(run[0][0]), ord(run[0][-1])
            points = np.frombuffer(run[0].encode("utf-32-le"), np.uint32) if last - first + 1 != len(run[0]) else slice(first, last + 1)
            out[points] = kind
    return out


def _word_encoder(path: str):  # noqa: ANN202
    """Encoder of one pre-token with the file's merges, or None if ids don't follow the merge order."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    # The public byte alphabet: printable bytes stand for themselves, the others follow from 256 on.
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain} | {
        chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [model["vocab"][m] for m in merges]
    if ids != sorted(ids) or not all(set(w) <= letters.keys() for w in merges) \
            or any(b not in model["vocab"] for b in letters):
        return None
    ranks = {bytes(letters[c] for c in w): model["vocab"][w] for w in [*letters, *merges]}
    encoder = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
    return encoder.encode_ordinary


class WordTable:
    """Ids of each pre-token seen, found by two independent 64-bit hashes."""

    MAX_WORDS = 1_000_000
    SHIFT = U64(46)  # 2**18 buckets

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.words = _word_encoder(path)
        self.classes = _classes()
        generator = np.random.Generator(np.random.PCG64(11))
        self.codes = [generator.integers(1, 1 << 63, 1 << 12, dtype=U64) for _ in range(4)]
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, U64)
        self.checks = np.zeros(0, U64)
        self.first = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    # The splitting pattern, in array form.
    def _starts(self, points: np.ndarray, kind: np.ndarray, text_start: np.ndarray) -> np.ndarray:
        """Mask of the positions where a pre-token starts."""
        n = len(points)
        new_text = np.zeros(n + 1, bool)
        new_text[text_start] = True
        change = np.empty(n, bool)
        change[0] = True
        np.not_equal(kind[1:], kind[:-1], out=change[1:])
        change |= new_text[:n]
        space = kind == SPACE
        # The last of a white-space run before a word: a plain space joins the
        # word, anything else stands alone; the rest of the run is one token.
        last_space = np.zeros(n, bool)
        last_space[:-1] = space[:-1] & ~space[1:] & ~new_text[1:n]
        starts = change | last_space
        joins = np.flatnonzero(last_space & (points == 32)) + 1
        starts[joins] = False
        return starts

    def _encode_words(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets by text)."""
        whole = [i for i, t in enumerate(texts) if "'" in t or any(s in t for s in self.special)]
        if whole:
            aside = dict(zip(whole, self._encode_words([texts[i] for i in whole]), strict=True))
            ids, offsets = self.encode(["" if i in aside else t for i, t in enumerate(texts)])
            parts = [np.array(aside[i], np.uint32) if i in aside else ids[offsets[i]:offsets[i + 1]]
                     for i in range(len(texts))]
            return np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        joined = "".join(texts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        borders = np.concatenate([[0], np.cumsum(lengths)])
        if not joined:
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.flatnonzero(self._starts(points, self.classes[points], borders))
        ends = np.append(starts[1:], len(points))
        low, high = points & 4095, points >> 12
        inverse = powers(BASE_INVERSE, len(points) + 1)[starts]
        keys, checks = (
            mix((sums[ends] - sums[starts]) * inverse + (ends - starts).astype(U64))
            for sums in (prefix_hash(a[low] + b[high]) for a, b in (self.codes[:2], self.codes[2:])))
        at, found = self._find(keys)
        if not found.all():
            if len(self.keys) > self.MAX_WORDS:
                self._clear()
                found[:] = False
            self._learn(joined, starts, ends, keys, checks, np.flatnonzero(~found))
            at, _ = self._find(keys)
        if not np.array_equal(self.checks[at], checks):  # two words share a key: the library decides
            parts = self._encode_words(texts)
            return np.concatenate([np.array(p, np.uint32) for p in parts]), np.cumsum([0, *map(len, parts)])
        count, first = self.count[at], self.first[at]
        ends_of = np.cumsum(count)
        total = int(ends_of[-1])
        source = np.arange(total) + np.repeat(first - (ends_of - count), count)
        by_text = np.searchsorted(starts, borders)
        return self.ids[source], np.concatenate([[0], ends_of])[by_text]

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, found) of each key: its bucket of leading bits, then a few steps."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        bucket = (keys >> self.SHIFT).astype(np.int64)
        at, end = self.jump[bucket], self.jump[bucket + 1]
        open_ = np.flatnonzero(at < end)
        while len(open_):
            open_ = open_[self.keys[at[open_]] < keys[open_]]
            at[open_] += 1
            open_ = open_[at[open_] < end[open_]]
        at[at == len(self.keys)] = 0
        return at, self.keys[at] == keys

    def _learn(self, joined: str, starts, ends, keys, checks, missing) -> None:  # noqa: ANN001
        fresh, where = np.unique(keys[missing], return_index=True)
        where = missing[where]
        fresh_words = [joined[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
        encoded = [self.words(w) for w in fresh_words] if self.words else self._encode_words(fresh_words)
        count = np.fromiter(map(len, encoded), np.int64, len(encoded))
        first = len(self.ids) + np.cumsum(count) - count
        self.ids = np.concatenate([self.ids, np.fromiter((x for e in encoded for x in e), np.uint32, int(count.sum()))])
        merged = np.concatenate([self.keys, fresh])
        order = np.argsort(merged, kind="stable")
        self.keys = merged[order]
        sizes = np.bincount((self.keys >> self.SHIFT).astype(np.int64), minlength=1 << 18)
        self.jump = np.concatenate([[0], np.cumsum(sizes)])
        self.checks = np.concatenate([self.checks, checks[where]])[order]
        self.first = np.concatenate([self.first, first])[order]
        self.count = np.concatenate([self.count, count])[order]


_tables: dict[str, WordTable] = {}


def word_table(path: str) -> WordTable:
    """The process's table for a vocabulary file (made on first use)."""
    if path not in _tables:
        _tables[path] = WordTable(path)
    return _tables[path]


# --- assignment ------------------------------------------------------------------------

def assign(lengths: list[int], capacity: int, linear: float, quadratic: float
           ) -> list[tuple[int, int, int, int, int]]:
    """Lay items into sequences: (item, start in item, length, sequence, offset).

    Descending items go to the lowest-cost open sequence; see the module text.
    """
    bins = -(-sum(lengths) // capacity)
    heap = [(0.0, b) for b in range(bins)]  # a valid heap: equal costs, ascending numbers
    used = [0] * bins
    items = [(-n, i, 0) for i, n in enumerate(lengths) if n]
    heapq.heapify(items)
    out = []
    while items:
        size, item, start = heapq.heappop(items)
        cost, b = heapq.heappop(heap)
        take = min(-size, capacity - used[b])
        out.append((item, start, take, b, used[b]))
        used[b] += take
        if used[b] < capacity:
            heapq.heappush(heap, (cost + linear * take + quadratic * take * take, b))
        if take < -size:
            heapq.heappush(items, (size + take, item, start + take))
    return out


# --- Spark ---------------------------------------------------------------------------------

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, cost double")
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                    ("offset", pa.int64()), ("cost", pa.float64())])
_IDS = pa.field("ids", pa.list_(pa.int32()))


def pack(docs: DataFrame, settings: Settings, with_ids: bool = False) -> DataFrame:
    """One row per piece of each document of ``docs`` (``doc_id``, ``text``).

    ``start`` counts the document's tokens before the piece, ``offset`` those
    of the sequence; ``ids_crc32`` is over the piece's ids as little-endian
    32-bit numbers; ``cost`` is the piece's estimated cost. ``with_ids`` adds the ids themselves.
    """
    capacity = settings.capacity
    schema = _ARROW.append(_IDS) if with_ids else _ARROW

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table(settings.tokenizer)
        context = TaskContext.get()
        sequence = (context.partitionId() if context else 0) << 40
        columns: dict[str, list] = {f.name: [] for f in schema}
        rests: list[tuple] = []  # doc_id, start, ids, doc_tokens
        open_tokens = 0

        def piece(doc_id, start: int, ids: np.ndarray, tokens: int, number: int, offset: int) -> None:  # noqa: ANN001
            n = len(ids)
            row = (doc_id, start, n, zlib.crc32(ids), tokens, number, offset,
                   settings.linear * n + settings.quadratic * n * n)
            for name, value in zip(columns, row, strict=False):
                columns[name].append(value)
            if with_ids:
                columns["ids"].append(ids.astype(np.int32).tolist())

        def close() -> None:
            nonlocal sequence, open_tokens
            laid = assign([len(r[2]) for r in rests], capacity, settings.linear, settings.quadratic)
            for item, start, length, b, offset in laid:
                doc_id, before, ids, tokens = rests[item]
                piece(doc_id, before + start, ids[start:start + length], tokens, sequence + b, offset)
            sequence += 1 + max((b for *_, b, _ in laid), default=-1)
            rests.clear()
            open_tokens = 0

        def flushed() -> pa.RecordBatch:
            batch = batch_of(columns, schema)
            for values in columns.values():
                values.clear()
            return batch

        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            _, sizes = utf8_parts(batch.column("text"))
            row = 0
            while row < batch.num_rows:
                end = max(row + 1, int(np.searchsorted(sizes, sizes[row] + SLICE_BYTES, "right")) - 1)
                end = min(end, batch.num_rows)
                texts = [t or "" for t in batch.column("text").slice(row, end - row).to_pylist()]
                ids, offsets = table.encode(texts)
                for i in range(end - row):
                    own = np.append(ids[offsets[i]:offsets[i + 1]], np.uint32(settings.end_id))
                    tokens = len(own)
                    full = tokens // capacity * capacity
                    for start in range(0, full, capacity):
                        piece(doc_ids[row + i], start, own[start:start + capacity], tokens, sequence, 0)
                        sequence += 1
                    if full < tokens:
                        rests.append((doc_ids[row + i], full, own[full:].copy(), tokens))
                        open_tokens += tokens - full
                        if open_tokens >= settings.block_tokens:
                            close()
                row = end
                if len(columns["start"]) >= 5000:
                    yield flushed()
        close()
        yield flushed()

    return docs.select("doc_id", "text").mapInArrow(
        packed, PIECES + (", ids array<int>" if with_ids else ""))
