"""Context-triggered piecewise hashing: similarity-preserving text fingerprints.

A rolling hash over the last seven bytes triggers chunk borders; each chunk
becomes one two-character code, so an edit changes only the codes of the
chunks it touches. The trigger is the number of trailing one bits of the
rolling hash: block size ``2**k`` cuts where at least ``k`` of them are set, so all block
sizes come from one pass and the borders of a larger size are a subset of
those of a smaller one. A text takes the smallest block size (4 or more)
with at most :data:`MAX_CHUNKS` chunks and also carries the signature of the
next size. Two fingerprints are compared at the block sizes they share, by
edit distance over chunk codes.

Cases: null text is read as empty. Empty texts have the fingerprint
``4::`` and are alike (1.0) to each other and unlike (0.0) anything else.
Equal texts have equal fingerprints. No text is cut off: a
long one takes a larger block size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODES, U64, batch_of, mix, prefix_hash, span_hash, text_or_empty

MAX_CHUNKS = 64
MIN_LEVEL = 2
MAX_LEVEL = 40
WINDOW = 7
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
PIECE = 1 << 17

# --- one fingerprint ------------------------------------------------------------

_WINDOW_CODES = [mix(BYTE_CODES + U64(7919 * i)) for i in range(WINDOW)]


def trigger_levels(data: np.ndarray) -> np.ndarray:
    """Trailing one bits of the rolling hash ending at each byte.

    Only positions of at least :data:`MIN_LEVEL` matter; computed in pieces
    that stay in cache.
    """
    n = len(data)
    levels = np.zeros(n, np.uint8)
    for at in range(0, n, PIECE):
        first = max(0, at - WINDOW + 1)
        part = data[first:at + PIECE]
        rolling = _WINDOW_CODES[0][part]
        for i in range(1, min(WINDOW, len(part))):
            rolling[i:] += _WINDOW_CODES[i][part[:-i]]
        rolling ^= rolling >> U64(29)
        rolling *= U64(0xBF58476D1CE4E5B9)
        rolling = rolling[at - first:] >> U64(20)
        hit = np.flatnonzero((rolling & U64(3)) == 3)
        bits = rolling[hit]
        lowest_zero = ~bits & (bits + U64(1))
        levels[at + hit] = np.minimum(np.log2(lowest_zero.astype(np.float64)), MAX_LEVEL).astype(np.uint8)
    return levels


def _signature(sums: np.ndarray, ends: np.ndarray, n: int) -> str:
    if n == 0:
        return ""
    if not len(ends) or ends[-1] != n:
        ends = np.append(ends, n)
    starts = np.concatenate([[0], ends[:-1]])
    codes = span_hash(sums, starts, ends)
    high, low = (codes >> U64(58)).tolist(), ((codes >> U64(52)) & U64(63)).tolist()
    return "".join(ALPHABET[a] + ALPHABET[b] for a, b in zip(high, low, strict=True))


def fingerprint(text: bytes) -> str:
    """``block:signature:signature of the doubled block`` of a text's bytes."""
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    if n == 0:
        return f"{1 << MIN_LEVEL}::"
    levels = trigger_levels(data)
    cuts = np.flatnonzero(levels >= MIN_LEVEL)
    at_cut = levels[cuts]
    left = np.cumsum(np.bincount(at_cut, minlength=MAX_LEVEL + 2)[::-1])[::-1]
    level = MIN_LEVEL
    while level < MAX_LEVEL and left[level] >= MAX_CHUNKS:
        level += 1
    sums = prefix_hash(BYTE_CODES[data])
    one = _signature(sums, cuts[at_cut >= level] + 1, n)
    two = _signature(sums, cuts[at_cut >= level + 1] + 1, n)
    return f"{1 << level}:{one}:{two}"


# --- comparison ---------------------------------------------------------------------

def edit_distance(a: list[str], b: list[str]) -> int:
    """Levenshtein distance with bit-parallel columns (one integer per column)."""
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    last, full = 1 << (len(a) - 1), (1 << len(a)) - 1
    up, down, distance = full, 0, len(a)
    for y in b:
        match = where.get(y, 0)
        diagonal = (((match & up) + up) ^ up) | match | down
        plus = down | ~(diagonal | up) & full
        minus = up & diagonal
        if plus & last:
            distance += 1
        elif minus & last:
            distance -= 1
        plus = (plus << 1 | 1) & full
        minus = minus << 1 & full
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
    return distance


def _codes(signature: str) -> list[str]:
    return [signature[i:i + 2] for i in range(0, len(signature), 2)]


def likeness(a: str, b: str) -> float:
    """0 to 1: the best ``1 - distance / longer length`` over shared block sizes."""
    if a == b:
        return 1.0
    block_a, *signatures_a = a.split(":")
    block_b, *signatures_b = b.split(":")
    sizes_a = {int(block_a) << i: s for i, s in enumerate(signatures_a)}
    sizes_b = {int(block_b) << i: s for i, s in enumerate(signatures_b)}
    best = 0.0
    for size in sizes_a.keys() & sizes_b.keys():
        x, y = _codes(sizes_a[size]), _codes(sizes_b[size])
        longest = max(len(x), len(y))
        if x and y and set(x) & set(y):
            best = max(best, 1.0 - edit_distance(x, y) / longest)
    return best


# --- Spark ---------------------------------------------------------------------------

def fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint of each whole text; no shuffle."""
    @F.arrow_udf("string")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.encode("utf-8", "surrogatepass")) for t in texts.to_pylist()], pa.string())

    return df.withColumn(out, of(text_or_empty(text)))


_SUCCESSOR = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
              "edited_fingerprint string, near_edited double, near_next double")
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                    ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            yield from zip(*(part.column(c).to_pylist() for c in ("run", "halo", "doc_id", "text")), strict=True)


def _compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (run, halo, order): each is compared with the one after it."""
    out: dict[str, list] = {f.name: [] for f in _ARROW}

    def emit(row: tuple, following: tuple) -> None:
        (doc_id, text, own), (_, next_text, next_own) = row, following
        cut = len(text) // 3
        edited = text[:len(text) - cut] + next_text[:cut]
        raw = edited.encode("utf-8", "surrogatepass")
        changed = own if edited == text else fingerprint(raw)
        values = (doc_id, len(text), hashlib.sha256(raw).hexdigest(), own, changed,
                  likeness(own, changed), likeness(own, next_own))
        for name, value in zip(out, values, strict=True):
            out[name].append(value)

    current, run_of, done = None, None, False
    for run, halo, doc_id, text in _rows(batches):
        if run != run_of:
            current, run_of, done = None, run, False
        if done:
            continue
        row = (doc_id, text, fingerprint(text.encode("utf-8", "surrogatepass")))
        if current is not None:
            emit(current, row)
        current, done = row, bool(halo)
        if len(out["doc_id"]) >= 1000:
            yield batch_of(out, _ARROW)
            for values in out.values():
                values.clear()
    yield batch_of(out, _ARROW)


def compare_with_next(docs: DataFrame, runs: int | None = None) -> DataFrame:
    """Fingerprints of each text, of its edit by the next text, and their likeness.

    "Next" is the following row by descending ``doc_id`` (null ids last, equal
    ids by ascending text, whole repeats next to each other); the last row's next is the first. The edit
    replaces the last third of a text's code points by the first as many of
    the next text. One row per input row; other input columns are not read.

    The order is global without a global sort in one task: ``runs`` key ranges
    come from approximate quantiles of the ids; the first row of a range is
    also copied to the range before it (one copied row a range, plus repeats
    of that id). Texts are shuffled once. Ids are expected to be nearly
    unique; rows of one id share a task.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    runs = runs or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(rows.approxQuantile("doc_id", [i / runs for i in range(1, runs)], 0.5 / runs)))
    ids = rows.withColumn("_id", F.coalesce(F.col("doc_id").cast("double"), F.lit(0.0)))
    ids = Bucketizer(splits=[float("-inf"), *(cuts or [0.0]), float("inf")], inputCol="_id", outputCol="_b").transform(ids)
    # Ranges are numbered by descending id, nulls last.
    ranged = ids.select(F.when(F.col("doc_id").isNull(), len(cuts) + 2).otherwise(-F.col("_b")).cast("int").alias("run"),
                        "doc_id", "text")
    tops = sorted((r["run"], r["top"]) for r in
                  ranged.groupBy("run").agg(F.max("doc_id").alias("top")).collect())  # one row a range
    if not tops:
        return spark.createDataFrame([], _SUCCESSOR)
    before = [(run, tops[i - 1][0], top) for i, (run, top) in enumerate(tops)]  # of the first range: the last
    heads = F.broadcast(spark.createDataFrame(before, "run int, before int, top long"))
    stay, copy = (F.struct(F.col(c).alias("run"), F.lit(h).alias("halo")) for c, h in (("run", 0), ("before", 1)))
    copies = F.when(F.col("doc_id").eqNullSafe(F.col("top")), F.array(stay, copy)).otherwise(F.array(stay))
    ranked = ranged.join(heads, "run").withColumn("_copies", copies)
    dealt = (ranked.select("doc_id", "text", F.explode("_copies").alias("c"))
             .select("c.run", "c.halo", "doc_id", "text")
             .repartition("run")
             .sortWithinPartitions("run", "halo", F.col("doc_id").desc_nulls_last(), "text"))
    return dealt.mapInArrow(_compare_neighbours, _SUCCESSOR)

