"""Removal of long repeated byte strings with suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else (another text or another place of the same one) is removed. Strings
never cross texts and are judged on the input.

1. *Anchors.* Of the byte grams of half the length inside a window, the one
   with the least hash is an anchor. Equal windows have equal anchors at equal places, so a
   string that repeats holds an anchor whose gram repeats. Only texts and
   places with a repeating anchor go on.
2. *Contexts.* The windows around an anchor are split in two halves, by
   which side of the gram they reach further; all windows of a half hold a
   common stretch of three quarters of ``length``, and contexts are grouped by
   it. In a group, contexts that occur more than once are removed whole; only
   the distinct contexts of a group with several need sorting.
3. *Suffix arrays.* Distinct contexts are dealt into shards of bounded size
   and cut to what may repeat (:func:`shard_windows`). Per shard, a suffix array is
   built by Larsson-Sadakane refinement in numpy and Kasai's common prefixes
   tell which windows repeat.
Contexts, and windows compared across shards, are identified by two independent 64-bit
hashes of their bytes; within a shard bytes are compared.
4. *Merging.* A group with more contexts than a shard takes is spread over several.
   Their windows, one for each that repeats inside its shard, are dealt by
   hash into ranges, and binary search in the merged order of a range finds
   those that repeat across shards.

Equal whole texts are one text to steps 1 to 4: where a text of ``length``
bytes or more occurs twice, all of it is removed. Stage results are tables in the shared scratch folder; no group of
repeats is gathered in one task beyond a shard's bound.

Cases: null text is empty; a text shorter than ``length`` keeps all its
bytes. Rows with null or repeated ids are documents like others. One output row per input row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_CODES, U64, batch_of, byte_slices, mix, prefix_hash, saved, small_batches, span_hash, text_or_empty
from .decontam import grams

LEFT, RIGHT = 0, 1
# A scan holds some 60 bytes of hashes for each byte of a slice.
SCAN_BYTES = 1 << 18
# Codes of a second hash, independent of the first (fixed seed: equal in all tasks).
SECOND_CODES = np.random.Generator(np.random.PCG64(20240301)).integers(1, 1 << 63, 256, dtype=U64) * U64(2) + U64(1)


@dataclass(frozen=True)
class Settings:
    length: int = 400  # a multiple of 4
    shard_contexts: int = 2_000
    range_rows: int = 200_000

    @property
    def gram(self) -> int:
        return self.length // 2

    @property
    def half(self) -> int:
        return self.length // 4


# --- anchors -----------------------------------------------------------------------

def _sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least (or greatest) of each run of ``width`` values."""
    n = len(values)
    if n < width:
        return values[:0]
    best, fill = (np.minimum, np.iinfo(np.uint64).max) if least else (np.maximum, 0)
    padded = np.full(-(-n // width) * width, fill, U64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    back = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(back[:n - width + 1], ahead[width - 1:n])


def anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places whose hash is the least of some ``width`` consecutive ones (all ties)."""
    least = _sliding(hashes, width, True)
    if not len(least):
        return np.zeros(0, np.int64)
    # Place i is picked if the greatest of the minima of its windows is its own hash.
    edge = np.zeros(width - 1, U64)
    greatest = _sliding(np.concatenate([edge, least, edge]), width, False)
    return np.flatnonzero(greatest == hashes)


# --- suffix arrays ---------------------------------------------------------------------

def larsson_sadakane(data: np.ndarray, depth: int, starts: np.ndarray) -> np.ndarray:
    """The suffixes at ``starts`` (a mask) sorted by their first ``depth`` bytes (8 or more).

    Suffixes begin sorted by eight bytes. A pass orders each unsettled group
    by the rank of what follows and so doubles the sorted length (the last
    one stops at ``depth``). It takes in only suffixes whose place is not settled and whose
    rank a later pass still asks for.
    """
    n = len(data)
    steps = []  # (sorted length before the pass, offset of what follows)
    length = 8
    while length < depth:
        steps.append((length, min(length, depth - length)))
        length += steps[-1][1]
    asked = [starts]
    for _, offset in reversed(steps):
        wider = asked[0].copy()
        wider[offset:] |= asked[0][:n - offset] if offset < n else False
        asked.insert(0, wider)
    key = grams(np.concatenate([data, np.zeros(7, np.uint8)]), 8)
    order = np.flatnonzero(asked[0])
    order = order[np.argsort(key[order])]
    ordered, m = key[order], len(order)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if m else np.zeros(0, np.int64)
    size = np.diff(np.append(first, m))
    group = np.repeat(first, size)
    rank = np.zeros(n + 1, np.int64)
    rank[order] = group + 1
    unsettled = np.flatnonzero(np.repeat(size, size) > 1)
    for (_, offset), wanted in zip(steps, asked[1:], strict=True):
        unsettled = unsettled[wanted[order[unsettled]]]
        if not len(unsettled):
            break
        place = order[unsettled]
        pair = group[unsettled] * (m + 2) + rank[np.minimum(place + offset, n)]
        by = np.argsort(pair)
        place, pair = place[by], pair[by]
        order[unsettled] = place
        fresh = np.ones(len(place), bool)
        fresh[1:] = pair[1:] != pair[:-1]
        group[unsettled] = np.maximum.accumulate(np.where(fresh, unsettled, 0))
        rank[place] = group[unsettled] + 1
        heads = np.flatnonzero(fresh)
        size = np.diff(np.append(heads, len(place)))
        unsettled = unsettled[np.repeat(size, size) > 1]
    return order[starts[order]]


def kasai(data: bytes, place: np.ndarray, before: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix ``place`` (ascending) with the one ``before`` it.

    Kasai's rule: the next suffix keeps all but one byte of the last common
    prefix, so every byte is compared about once.
    """
    out = np.zeros(len(place), np.int64)
    common, last, last_before = 0, -2, -2
    for at, (i, j, most) in enumerate(zip(place.tolist(), before.tolist(), limit.tolist(), strict=True)):
        common = common - 1 if common and i == last + 1 and j == last_before + 1 else 0
        while common < most:
            step = min(64, most - common)
            if data[i + common:i + common + step] == data[j + common:j + common + step]:
                common += step
                continue
            while data[i + common] == data[j + common]:
                common += 1
            break
        out[at] = common
        last, last_before = i, j
    return out


def repeated_windows(data: np.ndarray, start: np.ndarray, end: np.ndarray, identity: np.ndarray,
                     length: int, several: np.ndarray | None = None) -> np.ndarray:
    """Mask of the places at which a window repeats among segments [start, end) of ``data``.

    ``identity``: a number per segment, so that ``identity + offset`` is the
    window's place in the corpus; a window that two overlapping segments show
    twice is one. ``several``: segments that stand for more than one place.
    """
    n = len(data)
    repeats = np.zeros(n, bool)
    segment = np.repeat(np.arange(len(start)), end - start)
    left = end[segment] - np.arange(n)
    order = larsson_sadakane(data, length, left >= length)
    if len(order) < 2:
        return repeats
    before, after = order[:-1], order[1:]
    probe = grams(np.concatenate([data, np.zeros(7, np.uint8)]), 8)
    close = np.ones(len(before), bool)
    for offset in (0, length // 3, 2 * length // 3, length - 8):
        close &= probe[before + offset] == probe[after + offset]
    pairs = np.flatnonzero(close)
    by_place = np.argsort(after[pairs], kind="stable")
    pairs = pairs[by_place]
    limit = np.minimum(left[before[pairs]], left[after[pairs]])
    joined = np.zeros(len(order), bool)
    joined[pairs[kasai(data.tobytes(), after[pairs], before[pairs], limit) >= length] + 1] = True
    # Runs of suffixes that share a whole window, with the least and greatest corpus place.
    runs = np.flatnonzero(~joined)
    corpus_place = identity[segment[order]] + (order - start[segment[order]]).astype(U64)
    again = np.minimum.reduceat(corpus_place, runs) != np.maximum.reduceat(corpus_place, runs)
    if several is not None:
        again |= np.logical_or.reduceat(several[segment[order]], runs)
    repeats[order[np.repeat(again, np.diff(np.append(runs, len(order))))]] = True
    return repeats


def shard_windows(data: np.ndarray, start: np.ndarray, end: np.ndarray, identity: np.ndarray,
                  length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(segment, offset, hash, repeats) of every window of the segments of a shard.

    Of the windows with one hash, two at different places go on: they are cut
    out of their segments with what lies between, equal stretches are kept
    once, and the suffix array of the stretches tells whether the windows do
    repeat. The others with that hash follow them; a hash with one place repeats nothing.
    """
    count = np.maximum(end - start - length + 1, 0)
    segment = np.repeat(np.arange(len(start)), count)
    offset = np.arange(len(segment)) - np.repeat(np.cumsum(count) - count, count)
    sums = prefix_hash(BYTE_CODES[data])
    at = start[segment] + offset
    hashes = span_hash(sums, at, at + length)
    place = identity[segment] + offset.astype(U64)
    repeats = np.zeros(len(segment), bool)
    if not len(segment):
        return segment, offset, hashes, repeats
    order = np.argsort(hashes, kind="stable")
    runs = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))
    size = np.diff(np.append(runs, len(order)))
    other = place[order] != np.repeat(place[order[runs]], size)
    second = np.minimum.reduceat(np.where(other, np.arange(len(order)), len(order)), runs)
    more = second < len(order)
    leaders = order[runs[more]]
    picked = np.unique(np.concatenate([leaders, order[second[more]]]))
    if not len(picked):
        return segment, offset, hashes, repeats
    held, first = np.unique(segment[picked], return_index=True)
    last = np.append(first[1:], len(picked)) - 1
    low, high = offset[picked[first]], offset[picked[last]] + length
    raw = data.tobytes()
    known: dict[bytes, int] = {}
    owner, spot, several = np.empty(len(held), np.int64), [], []
    for i, (g, a, b) in enumerate(zip(start[held].tolist(), low.tolist(), high.tolist(), strict=True)):
        own = int(identity[held[i]]) + a
        owner[i] = j = known.setdefault(raw[g + a:g + b], len(known))
        if j == len(spot):
            spot.append(own)
            several.append(False)
        elif spot[j] != own:
            several[j] = True
    stretch = np.array([len(x) for x in known], np.int64)
    ends = np.cumsum(stretch)
    found = repeated_windows(np.frombuffer(b"".join(known), np.uint8), ends - stretch, ends,
                             np.array([x & (2**64 - 1) for x in spot], U64), length, np.array(several))
    index = np.searchsorted(held, segment[leaders])
    again = np.zeros(len(runs), bool)
    again[more] = found[(ends - stretch)[owner[index]] + offset[leaders] - low[index]]
    repeats[order] = np.repeat(again, size)
    return segment, offset, hashes, repeats


# --- Spark ---------------------------------------------------------------------------------

def anchor_table(docs: DataFrame, settings: Settings) -> DataFrame:
    """(h, text_key, pos): the anchors of each text of at least ``length`` bytes.

    A task scans each text once, however many copies of it it reads.
    """
    gram, width = settings.gram, settings.length - settings.gram + 1
    schema = pa.schema([("h", pa.int64()), ("text_key", pa.int64()), ("pos", pa.int32())])

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            fresh = [k not in seen and not seen.add(k) for k in batch.column("text_key").to_pylist()]
            batch = batch.filter(pa.array(fresh, pa.bool_()))
            keys = batch.column("text_key").to_numpy()
            for first, end, data, offsets in byte_slices(batch.column("text"), SCAN_BYTES):
                sums = prefix_hash(BYTE_CODES[data])
                every = np.arange(max(0, len(data) - gram + 1))
                hashes = span_hash(sums, every, every + gram)
                out_h, out_pos, out_n = [], [], []
                for i in range(end - first):
                    own = hashes[offsets[i]:max(offsets[i], offsets[i + 1] - gram + 1)]
                    pos = anchors(own, width)
                    out_h.append(own[pos])
                    out_pos.append(pos)
                    out_n.append(len(pos))
                yield batch_of({"h": np.concatenate(out_h).view(np.int64),
                                "text_key": np.repeat(keys[first:end], out_n),
                                "pos": np.concatenate(out_pos).astype(np.int32)}, schema)

    return docs.select("text_key", "text").mapInArrow(found, "h long, text_key long, pos int")


def _half(side: int, pos: int, n: int, settings: Settings) -> tuple[int, int, int, int] | None:
    """(context start, end, stretch start, end) of one half around an anchor, or None."""
    length, gram, half = settings.length, settings.gram, settings.half
    reach = length - gram
    if side == LEFT:
        bounds = max(0, pos - reach), min(n, pos + length - half), pos - half, pos + gram
    else:
        bounds = max(0, pos - half), min(n, pos + length), pos, pos + length - half
    fits = bounds[1] - bounds[0] >= length and bounds[2] >= 0 and bounds[3] <= n
    return bounds if fits else None


def _joint(one: np.ndarray, two: np.ndarray) -> pa.Array:
    """Two 64-bit hashes as one 16-byte identity."""
    both = np.ascontiguousarray(np.stack([one, two], axis=1))
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(both), [None, pa.py_buffer(both.tobytes())]).cast(pa.binary())


_CONTEXT = pa.schema([("g", pa.int64()), ("ctx", pa.binary()), ("text_key", pa.int64()), ("pos", pa.int32()),
                      ("side", pa.int32()), ("lead", pa.int32())])


def context_table(candidates: DataFrame, settings: Settings) -> DataFrame:
    """Half contexts of each candidate's repeating anchors: group hash ``g``, content hash ``ctx``."""
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, places = batch.column("text_key").to_pylist(), batch.column("places")
            for first, end, data, offsets in byte_slices(batch.column("text"), SCAN_BYTES):
                sums, again = prefix_hash(BYTE_CODES[data]), prefix_hash(SECOND_CODES[data])
                rows = []
                for i in range(first, end):
                    base, n = int(offsets[i - first]), int(offsets[i - first + 1] - offsets[i - first])
                    for pos in places[i].as_py():
                        for side in (LEFT, RIGHT):
                            bounds = _half(side, pos, n, settings)
                            if bounds:
                                rows.append((keys[i], pos, side, *(base + b for b in bounds), pos - bounds[0]))
                if rows:
                    text_key, pos, side, a, b, c, d, lead = (np.array(x, np.int64) for x in zip(*rows, strict=True))
                    yield batch_of({
                        "g": mix(span_hash(sums, c, d) + (side + 1).astype(U64)).view(np.int64),
                        "ctx": _joint(*(mix(span_hash(x, a, b) + (lead * 2 + side + 1).astype(U64)) for x in (sums, again))),
                        "text_key": text_key, "pos": pos.astype(np.int32), "side": side.astype(np.int32),
                        "lead": lead.astype(np.int32)}, _CONTEXT)

    return candidates.mapInArrow(found, "g long, ctx binary, text_key long, pos int, side int, lead int")


def _context_bytes(wanted: DataFrame, settings: Settings) -> DataFrame:
    """Bytes of the wanted contexts (``wants``: array of g, ctx, pos, side, shard per text)."""
    schema = pa.schema([("shard", pa.int64()), ("hot", pa.bool_()), ("g", pa.int64()), ("ctx", pa.binary()),
                        ("text_key", pa.int64()), ("at", pa.int64()), ("bytes", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keys, wants = (batch.column(c) for c in ("text", "text_key", "wants"))
            for i in range(batch.num_rows):
                raw = texts[i].as_py().encode("utf-8", "surrogatepass")
                out: dict[str, list] = {f.name: [] for f in schema}
                for w in wants[i].as_py():
                    bounds = _half(w["side"], w["pos"], len(raw), settings)
                    if bounds is None:
                        continue  # another text with this key
                    row = (w["shard"], w["hot"], w["g"], w["ctx"], keys[i].as_py(), bounds[0], raw[bounds[0]:bounds[1]])
                    for values, value in zip(out.values(), row, strict=True):
                        values.append(value)
                yield batch_of(out, schema)

    return wanted.mapInArrow(cut, "shard long, hot boolean, g long, ctx binary, text_key long, at long, bytes binary")


_RESULT = "g long, ctx binary, open boolean, w long, w2 long, place long, begin array<int>, finish array<int>"
_RESULT_ARROW = pa.schema([("g", pa.int64()), ("ctx", pa.binary()), ("open", pa.bool_()), ("w", pa.int64()), ("w2", pa.int64()),
                           ("place", pa.int64()), ("begin", pa.list_(pa.int32())), ("finish", pa.list_(pa.int32()))])


def _sort_shard(length: int):  # noqa: ANN202
    """Per shard: covered stretches of each context; of hot groups also the windows to compare with other shards."""
    def sort(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        raw = [x.as_py() for x in table.column("bytes")]
        end = np.cumsum([len(x) for x in raw])
        start = end - np.array([len(x) for x in raw])
        g, key, at = (table.column(c).to_numpy() for c in ("g", "text_key", "at"))
        ctx = table.column("ctx").combine_chunks()
        hot = np.array(table.column("hot").to_pylist(), bool)
        identity = mix(key.view(np.uint64)) + at.astype(U64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        segment, offset, hashes, repeats = shard_windows(data, start, end, identity, length)
        again = np.flatnonzero(repeats)
        of, spot = segment[again], offset[again]
        opens = np.ones(len(again), bool)
        opens[1:] = (of[1:] != of[:-1]) | (np.diff(spot) > length)
        head = np.flatnonzero(opens)
        tail = np.append(head[1:], len(again)) - 1 if len(head) else head
        each = np.arange(len(head) + 1, dtype=np.int32)
        none = np.zeros(len(head), np.int64)
        parts = [pa.Table.from_arrays([
            pa.array(g[of[head]]), ctx.take(pa.array(of[head])), pa.array(np.zeros(len(head), bool)),
            pa.array(none), pa.array(none), pa.array(none),
            *(pa.ListArray.from_arrays(each, pa.array(x.astype(np.int32))) for x in (spot[head], spot[tail] + length))],
            schema=_RESULT_ARROW)]
        if hot.any():
            # Windows not repeated here, and one of each that is: another shard may hold a single one.
            own = np.flatnonzero(hot[segment])
            known = own[repeats[own]]
            sums = prefix_hash(SECOND_CODES[data])
            windows = start[segment] + offset
            two = span_hash(sums, windows[known], windows[known] + length)
            by = np.lexsort((two, hashes[known]))
            fresh = np.ones(len(by), bool)
            fresh[1:] = (hashes[known][by][1:] != hashes[known][by][:-1]) | (two[by][1:] != two[by][:-1])
            keep = np.sort(np.concatenate([own[~repeats[own]], known[by[fresh]]]))
            each = np.arange(len(keep) + 1, dtype=np.int32)
            lists = [pa.ListArray.from_arrays(each, pa.array(x.astype(np.int32)))
                     for x in (offset[keep], offset[keep] + length)]
            place = identity[segment[keep]] + offset[keep].astype(U64)
            parts.append(pa.Table.from_arrays([
                pa.array(g[segment[keep]]), ctx.take(pa.array(segment[keep])), pa.array(np.ones(len(keep), bool)),
                pa.array(hashes[keep].view(np.int64)),
                pa.array(span_hash(sums, windows[keep], windows[keep] + length).view(np.int64)),
                pa.array(place.view(np.int64)), *lists], schema=_RESULT_ARROW))
        return pa.concat_tables(parts)

    return sort


def _merge_range(table: pa.Table) -> pa.Table:
    """Windows of a hash range that several shards (or places) hold, by binary search in the merged order."""
    w, w2, place = (table.column(c).to_numpy() for c in ("w", "w2", "place"))
    order = np.lexsort((place, w2, w))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (w[order][1:] != w[order][:-1]) | (w2[order][1:] != w2[order][:-1])
    merged, places = np.cumsum(fresh), place[order]
    rank = np.empty(len(order), np.int64)
    rank[order] = merged
    low, high = np.searchsorted(merged, rank, "left"), np.searchsorted(merged, rank, "right")
    return table.select(_RESULT_ARROW.names).filter(pa.array(places[low] != places[high - 1]))


def _join(stretches: pa.Array) -> pa.Array:
    """Sorted stretches with those that touch made one; a finish below 0 is the context's end."""
    out = []
    for row in stretches.to_pylist():
        merged: list[dict] = []
        for s in row:
            if merged and merged[-1]["finish"] < 0:
                break
            if s["finish"] < 0 and s["begin"] == 0:
                merged = [s]
            elif merged and s["begin"] <= merged[-1]["finish"]:
                merged[-1]["finish"] = max(merged[-1]["finish"], s["finish"])
            else:
                merged.append(s)
        out.append(merged)
    return pa.array(out, pa.list_(pa.struct([("begin", pa.int32()), ("finish", pa.int32())])))


def repeated_stretches(docs: DataFrame, settings: Settings) -> DataFrame:
    """(text_key, text, marks) of the texts with bytes to remove; ``docs`` has doc_id, text_key, text."""
    long_docs = docs.filter(F.octet_length("text") >= settings.length)
    found = saved(anchor_table(long_docs, settings), "repeat-anchors")
    place = F.xxhash64("text_key", "pos")
    repeating = (found.groupBy("h").agg(F.min(place).alias("low"), F.max(place).alias("high"))
                 .filter("low <> high").select("h"))
    places = (found.join(repeating, "h", "left_semi").groupBy("text_key")
              .agg(F.array_sort(F.collect_set("pos")).alias("places")))
    # One row per text: its copies are told apart by id; equal ids at worst repeat some work.
    first = long_docs.groupBy("text_key").agg(F.min("doc_id").alias("first_id"))
    chosen = places.join(first, "text_key").hint("shuffle_hash")
    same = long_docs["doc_id"].eqNullSafe(F.col("first_id"))
    candidates = saved(long_docs.join(chosen, "text_key").filter(same).select("text_key", "text", "places"),
                       "repeat-candidates")

    contexts = saved(context_table(candidates, settings), "repeat-contexts")
    held = contexts.groupBy("g", "ctx").agg(
        F.min(F.struct("text_key", "pos")).alias("rep"), (F.min(place) != F.max(place)).alias("several"),
        F.first("side").alias("side"), F.first("lead").alias("lead"))
    groups = held.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    held = saved(held.join(groups, "g").filter("n > 1 OR several"), "repeat-groups")
    distinct = held.filter("n > 1")
    total = distinct.count()
    shards = max(1, -(-total // settings.shard_contexts))
    per = settings.shard_contexts
    # A group of up to a shard's bound stays together; a larger one is spread over its own shards.
    shard = F.when(F.col("n") <= per // 2, F.pmod(F.xxhash64("g"), F.lit(shards))).otherwise(
        F.xxhash64("g", F.pmod(F.xxhash64("ctx"), F.ceil(F.col("n") * 2 / per))))
    wants = (distinct.select(F.col("rep.text_key").alias("text_key"), F.struct(
        "g", "ctx", F.col("rep.pos").alias("pos"), "side", shard.alias("shard"),
        (F.col("n") > per // 2).alias("hot")).alias("want"))
        .groupBy("text_key").agg(F.collect_list("want").alias("wants")))
    cut = _context_bytes(candidates.select("text_key", "text").join(wants.hint("shuffle_hash"), "text_key"), settings)
    sorted_ = saved(cut.groupBy("shard").applyInArrow(_sort_shard(settings.length), _RESULT), "repeat-shards")
    open_ = sorted_.filter("open")
    ranges = max(1, -(-open_.count() // settings.range_rows))
    merged = (open_.groupBy(F.pmod(F.xxhash64("w"), F.lit(ranges)).alias("range"))
              .applyInArrow(_merge_range, _RESULT))
    inside = sorted_.filter("NOT open").unionByName(merged).select("g", "ctx", F.explode(
        F.arrays_zip("begin", "finish")).alias("s")).select("g", "ctx", "s.begin", "s.finish")
    whole = held.filter("several").select("g", "ctx", F.lit(0).alias("begin"), F.lit(-1).alias("finish"))
    joined = F.arrow_udf(_join, "array<struct<begin:int,finish:int>>")
    removed = (whole.unionByName(inside).groupBy("g", "ctx")
               .agg(F.array_sort(F.collect_set(F.struct("begin", "finish"))).alias("found"))
               .select("g", "ctx", joined("found").alias("stretches")))
    # Back to every occurrence; a whole context ends where its half does in that text.
    spread = contexts.join(removed, ["g", "ctx"]).select(
        "text_key", F.struct("pos", "side", "lead", "stretches").alias("mark"))
    marks = spread.groupBy("text_key").agg(F.collect_list("mark").alias("marks"))
    return candidates.select("text_key", "text").join(marks.hint("shuffle_hash"), "text_key")


def _cleaned(settings: Settings):  # noqa: ANN202
    schema = pa.schema([("text_key", pa.int64()), ("digest", pa.string()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept_sha256", pa.string())])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in schema}
            for key, text, marks in zip(*(batch.column(c) for c in ("text_key", "text", "marks")), strict=True):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                begins, finishes = [], []
                for mark in marks.as_py():
                    bounds = _half(mark["side"], mark["pos"], len(raw), settings)
                    if bounds is None or mark["pos"] - bounds[0] != mark["lead"]:
                        continue  # another text with this key
                    for s in mark["stretches"]:
                        begins.append(bounds[0] + s["begin"])
                        finishes.append(bounds[1] if s["finish"] < 0 else bounds[0] + s["finish"])
                step = np.zeros(len(raw) + 1, np.int64)
                np.add.at(step, np.array(begins, np.int64), 1)
                np.add.at(step, np.array(finishes, np.int64), -1)
                gone = np.cumsum(step[:-1]) > 0
                spans = int((gone[1:] & ~gone[:-1]).sum() + (gone[0] if len(gone) else 0))
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                row = (key.as_py(), hashlib.md5(raw).hexdigest(), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
                for values, value in zip(out.values(), row, strict=True):
                    values.append(value)
            yield batch_of(out, schema)

    return clean


def remove_repeats(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each document row."""
    text = text_or_empty("text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64(text).alias("text_key"))
    with small_batches(docs.sparkSession):
        marked = repeated_stretches(rows, settings)
    cleaned = (marked.mapInArrow(_cleaned(settings),
                                 "text_key long, digest string, n_removed long, n_spans long, kept_sha256 string")
               .groupBy("digest").agg(*[F.first(c).alias(f"own_{c}") for c in ("n_removed", "n_spans", "kept_sha256")]))
    narrow = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.md5("text").alias("digest"),
                         F.sha2("text", 256).alias("sha"))
    copies = narrow.groupBy("digest").agg((F.count(F.lit(1)) > 1).alias("copied"))
    all_gone = F.col("copied") & (F.col("n_bytes") >= settings.length)
    return (narrow.join(copies, "digest").join(cleaned, "digest", "left")
            .select("doc_id", "n_bytes",
                    F.when(all_gone, F.col("n_bytes")).otherwise(F.coalesce("own_n_removed", F.lit(0))).alias("n_removed"),
                    F.when(all_gone, 1).otherwise(F.coalesce("own_n_spans", F.lit(0))).cast("long").alias("n_spans"),
                    F.when(all_gone, hashlib.sha256(b"").hexdigest())
                    .otherwise(F.coalesce("own_kept_sha256", "sha")).alias("kept_sha256")))
