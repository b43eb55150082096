"""Near-duplicate groups by SetSketch registers.

A document's set is its distinct word shingles. Its sketch holds, per
register, the least of exponentially distributed hash points of all shingles,
on a logarithmic scale and cut to 16 bits: ``clip(floor(1 - log_base(point)))``. Sketches merge by
maximum and agree in a register with about the sets' Jaccard similarity.

1. Documents with equal sets form a class (one partial aggregation).
2. Bands of ``band`` registers are bucket keys; similar classes share some
   bucket almost surely (at 0.8, 32 bands of 4: all but 5e-8 of pairs).
3. Each bucket proposes its least class to each other member: linear in the
   bucket, whatever its size. Likelihood over the registers and the exact set
   sizes estimates each proposed pair; those that could reach the threshold
   are confirmed on the full sets. Links give components.
4. Buckets that still hold several components look at all pairs across them.
   Those of at most ``small`` classes propose them at once. Larger ones are
   compared inside the tasks, block against block of at most about ``block`` classes or
   ``block_bytes`` bytes of sets: registers rule most pairs out, the full sets decide the
   others there and then, and a pair whose components have met meanwhile is passed over. Only links that
   join two components leave the task, so its output is linear in the classes.
5. Confirmed links of all rounds give the final components.

No bucket is capped or dropped, no task gathers a bucket of unbounded size,
and copies are never expanded into pairs. The register comparisons of step 4 grow with
the pairs of classes of a bucket that are in different components; rows and bytes do
not: a class of a large bucket travels once per block it meets. Stage results are tables
in the shared scratch folder.

Cases: null text is empty; a text without words has an empty set and is
linked with nothing; fewer words than a shingle are one shingle. Rows that
repeat an id are the same document. Rows with a null id are not linked:
their component is null and they are kept. Output rows match input rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, batch_of, byte_slices, mix, ordered_hash, saved, text_or_empty, word_hashes, words
from .components import components

SKETCH_SLICE = 2 << 20
TILE, ACROSS = 256, 2048  # pairs that are compared in one go


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    percent: int = 80
    registers: int = 128  # a power of two
    base: float = 1.001
    rate: float = 20.0
    limit: int = 65534
    band: int = 4
    small: int = 32
    block: int = 8192  # classes of a large bucket that a task compares with as many others
    block_bytes: int = 16 << 20  # bytes of their sets, about
    slack: float = 0.2  # a pair is dropped only if estimated this far under the threshold

    @property
    def bands(self) -> int:
        return self.registers // self.band

    def agreements(self) -> list[tuple[int, int]]:
        """(from, below) equal registers of the pairs of large buckets that are compared in full."""
        least = int(np.ceil((self.percent / 100 - self.slack) * self.registers))
        return [(least, self.registers + 1)]


# --- sets and sketches -----------------------------------------------------------

def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): each row's distinct shingles, ascending."""
    start, end, row = words(data, offsets)
    one = word_hashes(data, start, end)
    rows = len(offsets) - 1
    first = np.searchsorted(row, np.arange(rows + 1))
    have = np.diff(first)
    n = len(one) - size + 1
    full = ordered_hash([one[i:i + n] for i in range(size)], 17) if n > 0 else np.zeros(0, U64)
    sets = []
    for i in range(rows):
        a, k = int(first[i]), int(have[i])
        if k >= size:
            own = np.sort(full[a:a + k - size + 1])
            sets.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif k:
            sets.append(ordered_hash([one[a + j:a + j + 1] for j in range(k)], 100 + k))
        else:
            sets.append(np.zeros(0, U64))
    return (np.concatenate(sets) if sets else np.zeros(0, U64)), np.cumsum([0, *map(len, sets)])


def sketches(hashes: np.ndarray, offsets: np.ndarray, settings: Settings) -> np.ndarray:
    """(rows, registers) of 16-bit register values; rows with an empty set are all zero.

    Each element is a stream of points in time: gaps are exponential with
    rate ``rate * registers`` and each point falls on a random register, so
    that the first point on a register is exponential with ``rate``. A stream
    stops once it is past every register's least point.
    """
    rows, m = len(offsets) - 1, settings.registers
    least = np.full(rows * m, np.inf)
    filled = np.flatnonzero(np.diff(offsets) > 0)
    owner = np.repeat(np.arange(rows), np.diff(offsets))
    bound = np.full(rows, np.inf)
    seed, now, point = hashes, np.zeros(len(hashes)), 0
    while len(seed):
        point += 1
        bits = mix(seed + U64((point * 0x9E3779B97F4A7C15) & (2**64 - 1)))
        now = now - np.log((bits >> U64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / (settings.rate * m)
        alive = np.flatnonzero(now < bound[owner])
        seed, owner, now = seed[alive], owner[alive], now[alive]
        # Low bits pick the register; the time comes from the high ones.
        register = (mix(bits[alive]) & U64(m - 1)).astype(np.int64)
        np.minimum.at(least, owner * m + register, now)
        if point < 16 or point % 8 == 0:
            bound = least.reshape(rows, m).max(axis=1, initial=0.0) if m else bound
    out = np.zeros((rows, m), np.uint16)
    values = 1.0 - np.log(least.reshape(rows, m)[filled]) / np.log(settings.base)
    out[filled] = np.clip(np.floor(values), 0, settings.limit + 1).astype(np.uint16)
    return out


def likely_jaccard(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray,
                   base: float) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of sketch pairs with known set sizes."""
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - above - below
    u = size_a / (size_a + size_b)
    v = 1.0 - u
    share = (base - 1.0) / base

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * share) / np.log(base)

    def score(j: np.ndarray) -> np.ndarray:
        p, q = chance(u - v * j), chance(v - u * j)
        tiny = 1e-12
        return (above * np.log(np.maximum(p, tiny)) + below * np.log(np.maximum(q, tiny))
                + equal * np.log(np.maximum(1.0 - p - q, tiny)))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood has one peak
        third = (high - low) / 3
        left, right = low + third, high - third
        better = score(left) < score(right)
        low, high = np.where(better, left, low), np.where(better, high, right)
    return (low + high) / 2


def _rows_of(binary: pa.Array, dtype: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(binary.to_pylist()), dtype).reshape(len(binary), width)


# --- Spark: sketches and classes -------------------------------------------------------

_SKETCH = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()),
                     ("set_b", pa.int64()), ("sketch", pa.binary())])


def sketch_table(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, n_shingles, a 128-bit identity of the set, and the sketch of each row."""
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in byte_slices(batch.column("text"), SKETCH_SLICE):
                hashes, at = shingle_sets(data, offsets, settings.shingle)
                registers = sketches(hashes, at, settings)
                sums = [np.concatenate([np.zeros(1, U64), np.cumsum(mix(hashes ^ U64(c)))]) for c in (0x5A5A5A5A, 0xC3C3C3C3C3)]
                one, two = ((s[at[1:]] - s[at[:-1]]).view(np.int64) for s in sums)
                yield batch_of({"doc_id": batch.column("doc_id").slice(first, end - first),
                                "n_shingles": np.diff(at), "set_a": one, "set_b": two,
                                "sketch": [r.tobytes() for r in registers]}, _SKETCH)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return rows.mapInArrow(sketched, "doc_id long, n_shingles long, set_a long, set_b long, sketch binary")


def set_table(docs: DataFrame, ids: DataFrame, settings: Settings) -> DataFrame:
    """(id, set): the full ascending shingle hashes of the documents in ``ids``."""
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in byte_slices(batch.column("text"), SKETCH_SLICE):
                hashes, at = shingle_sets(data, offsets, settings.shingle)
                yield batch_of({"id": batch.column("id").slice(first, end - first),
                                "set": [hashes[at[i]:at[i + 1]].tobytes() for i in range(end - first)]},
                               pa.schema([("id", pa.int64()), ("set", pa.binary())]))

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_or_empty("text").alias("text"))
    # The narrow side is hashed; the texts are streamed past it unsorted.
    return rows.join(ids.hint("shuffle_hash"), "id", "left_semi").mapInArrow(listed, "id long, set binary")


# --- Spark: links ---------------------------------------------------------------------------

def confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold: estimated, then compared in full."""
    width, base = settings.registers, settings.base
    floor, percent = settings.percent / 100 - settings.slack, settings.percent

    @F.arrow_udf("boolean")
    def possible(sketch_a: pa.Array, sketch_b: pa.Array, n_a: pa.Array, n_b: pa.Array) -> pa.Array:
        if not len(n_a):
            return pa.array([], pa.bool_())
        estimate = likely_jaccard(_rows_of(sketch_a, np.uint16, width), _rows_of(sketch_b, np.uint16, width),
                                  n_a.to_numpy(zero_copy_only=False), n_b.to_numpy(zero_copy_only=False), base)
        return pa.array(estimate >= floor)

    @F.arrow_udf("boolean")
    def alike(set_a: pa.Array, set_b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(set_a, set_b, strict=True):
            a, b = np.frombuffer(x.as_py(), U64), np.frombuffer(y.as_py(), U64)
            both = np.sort(np.concatenate([a, b]), kind="stable")
            shared = int((both[1:] == both[:-1]).sum())
            out.append(100 * shared >= percent * (len(a) + len(b) - shared))
        return pa.array(out, pa.bool_())

    one = classes.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
    two = classes.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    sized = (pairs.join(one, "a").join(two, "b")
             .filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent))
    likely = sized.filter(possible("sketch_a", "sketch_b", "n_a", "n_b")).select("a", "b")
    full = (likely.join(sets.select(F.col("id").alias("a"), F.col("set").alias("set_a")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("set").alias("set_b")), "b"))
    return full.filter(alike("set_a", "set_b")).select("a", "b").distinct()


def _pairs_within(grouped: DataFrame) -> DataFrame:
    """Cross-component pairs of each group's bounded ``members`` (struct id, component)."""
    a, b = F.col("x"), F.col("y")
    return (grouped.select("members", F.explode("members").alias("x"))
            .select("x", F.explode("members").alias("y"))
            .filter((a["id"] < b["id"]) & (a["component"] != b["component"]))
            .select(a["id"].alias("a"), b["id"].alias("b")))


def _across(rows: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Rows (key, id, component, ...) of mixed buckets: pairs of the small ones, rows of the large ones."""
    state = (rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("low"),
                                     F.max("component").alias("high"))
             .filter("low < high").select("key", "size"))
    mixed = rows.join(state, "key")
    small = (mixed.filter(F.col("size") <= settings.small).groupBy("key")
             .agg(F.collect_list(F.struct("id", "component")).alias("members")))
    return _pairs_within(small), mixed.filter(F.col("size") > settings.small)


def tiles(x: dict[str, np.ndarray], y: dict[str, np.ndarray], low: int, high: int, percent: int,
          bands: tuple[int, int], component_of: Callable[[np.ndarray], np.ndarray]
          ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions in x and in y of the pairs across components that agree in ``low`` to under ``high``
    registers and may reach the threshold by size, a tile at a time.

    x and y hold component and n of the classes, and their sketches a
    register a row. If y is x, each pair is looked at once. ``component_of`` gives the components as
    they are when a tile is begun. ``bands`` is the band of the bucket and its width: pairs that an
    earlier band holds too are left to that band's bucket, which is as mixed as this one.
    """
    size = len(x["n"])
    for i in range(0, size, TILE):
        rows = slice(i, i + TILE)
        for j in range(i if y is x else 0, len(y["n"]), ACROSS):
            columns = slice(j, j + ACROSS)
            n, m = x["n"][rows, None], y["n"][None, columns]
            near = component_of(x["component"][rows])[:, None] != component_of(y["component"][columns])[None, :]
            near &= np.minimum(n, m) * 100 >= np.maximum(n, m) * percent
            if not near.any():
                continue
            equal = np.zeros(near.shape, np.uint16)
            for one, two in zip(x["sketch"][:, rows], y["sketch"][:, columns], strict=True):
                equal += one[:, None] == two[None, :]
            a, b = np.nonzero(near & (equal >= low) & (equal < high))
            if y is x:
                once = a + i < b + j
                a, b = a[once], b[once]
            first = first_shared(x["sketch"][:, a + i].T, y["sketch"][:, b + j].T, *bands)
            yield a[first] + i, b[first] + j


def agreeing(x: dict[str, np.ndarray], y: dict[str, np.ndarray], low: int, high: int,
             percent: int, bands: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The ids (lesser, greater) of all pairs that :func:`tiles` finds, whatever their sets."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    found += [(x["id"][a], y["id"][b]) for a, b in tiles(x, y, low, high, percent, bands, lambda c: c)]
    a, b = (np.concatenate(side) for side in zip(*found, strict=True))
    return np.minimum(a, b), np.maximum(a, b)


class Sets:
    """Full sets of a block's classes, as numbers into the block's own vocabulary."""

    def __init__(self, binary: pa.Array):
        raw = binary.to_pylist()
        self.at = np.cumsum([0, *(len(r) // 8 for r in raw)])
        _, self.terms = np.unique(np.frombuffer(b"".join(raw), U64), return_inverse=True)
        self.marked = np.zeros(int(self.terms.max(initial=-1)) + 1, bool)

    def shared(self, one: int, others: np.ndarray) -> np.ndarray:
        """Size of the intersection of one set with each of the others (none of them empty)."""
        own = self.terms[self.at[one]:self.at[one + 1]]
        self.marked[own] = True
        starts, lengths = self.at[others], self.at[others + 1] - self.at[others]
        first = np.cumsum(lengths) - lengths
        places = np.arange(int(lengths.sum())) + np.repeat(starts - first, lengths)
        counts = np.add.reduceat(self.marked[self.terms[places]].astype(np.int64), first)
        self.marked[own] = False
        return counts


class Joined:
    """Components of a block (0, 1, ...) and which of them its links have joined."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def __call__(self, component: np.ndarray) -> np.ndarray:
        return self.of[component]

    def join(self, one: int, two: int) -> bool:
        """Join two components; False if they were one already."""
        a, b = self.of[one], self.of[two]
        if a == b:
            return False
        self.of[self.of == max(a, b)] = min(a, b)
        return True


def links_within(x: dict[str, np.ndarray], y: dict[str, np.ndarray], sets: Sets, components_: int,
                 bands: tuple[int, int], settings: Settings) -> list[tuple[int, int]]:
    """Links (lesser id, greater id) that join components of a block or of two blocks; x and y as in :func:`tiles`.

    ``component`` holds numbers under ``components_``, ``row`` the places of the classes in ``sets``. Pairs
    are decided on their full sets; every link left out joins what the links given have joined.
    """
    (low, high), percent = settings.agreements()[0], settings.percent
    joined, links = Joined(components_), []
    for a, b in tiles(x, y, low, high, percent, bands, joined):
        bounds = np.append(np.flatnonzero(np.diff(a, prepend=-1)), len(a))
        for start, end in zip(bounds[:-1], bounds[1:], strict=True):
            one, others = a[start], b[start:end]
            others = others[joined(y["component"][others]) != joined(x["component"][one:one + 1])]
            if not len(others):
                continue
            shared = sets.shared(x["row"][one], y["row"][others])
            alike = others[100 * shared >= percent * (x["n"][one] + y["n"][others] - shared)]
            for other in alike:
                if joined.join(x["component"][one], y["component"][other]):
                    p, q = int(x["id"][one]), int(y["id"][other])
                    links.append((min(p, q), max(p, q)))
    return links


def first_shared(one: np.ndarray, two: np.ndarray, band: int, width: int) -> np.ndarray:
    """Whether no band of ``width`` registers before ``band`` agrees in the pairs of sketches (a pair a row)."""
    end = band * width
    return ~(one[:, :end] == two[:, :end]).reshape(len(one), band, width).all(axis=2).any(axis=1)


def _links_of_large(large: DataFrame, grouped: DataFrame, classes: DataFrame, sets: DataFrame,
                    settings: Settings) -> DataFrame:
    """Links across components within each key of ``large`` (key, band, id), enough to join all they join.

    The classes of a key are dealt into blocks, and every two blocks meet in one group.
    """
    width = settings.registers

    def compared(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        names, component = np.unique(group["component"].to_numpy(), return_inverse=True)
        order = np.argsort(component, kind="stable")  # tiles of one component are passed over
        part = group["part"].to_numpy()[order]
        sketch = _rows_of(group["sketch"], np.uint16, width)[order]
        whole = {"id": group["id"].to_numpy()[order], "component": component[order], "n": group["n"].to_numpy()[order],
                 "row": order}

        def side(at: np.ndarray) -> dict[str, np.ndarray]:
            return {k: v[at] for k, v in whole.items()} | {"sketch": np.ascontiguousarray(sketch[at].T)}

        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        x = side(part == i)
        found = links_within(x, x if i == j else side(part == j), Sets(group["set"].combine_chunks()), len(names),
                             (group["band"][0].as_py(), settings.band), settings)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    labelled = (large.join(grouped, "id", "left")
                .select("key", "band", "id", F.coalesce("component", "id").alias("component"))
                .join(classes.select("id", "n"), "id"))
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / settings.block), F.ceil(F.sum("n") * 8 / settings.block_bytes))
    state = (labelled.groupBy("key").agg(blocks.cast("int").alias("parts"), F.min("component").alias("least"),
                                         F.max("component").alias("most"))
             .filter("least < most").select("key", "parts"))
    mixed = (labelled.join(state, "key")
             .withColumn("part", F.pmod(F.xxhash64("id", "key"), F.col("parts")).cast("int"))
             .join(classes.select("id", "sketch").join(sets, "id"), "id"))
    met = (mixed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
           .select("key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
                   "part", "band", "id", "component", "n", "sketch", "set"))
    return met.groupBy("key", "i", "j").applyInArrow(compared, "a long, b long")


def _widened(grouped: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component) of ``grouped`` and of what further links (a, b) add to it."""
    one, two = (grouped.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}")) for c in ("a", "b"))
    between = (links.join(one, "a", "left").join(two, "b", "left")
               .select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")))
    merged = components(between)
    inner = merged.select(F.col("id").alias("component"), F.col("component").alias("wider"))
    return (grouped.join(inner, "component", "left").select("id", F.coalesce("wider", "component").alias("component"))
            .unionByName(merged.join(grouped, "id", "left_anti")))


def grouped_classes(docs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """(id, component) of every class that has a link."""
    two = 2 * settings.band
    keys = F.transform(F.sequence(F.lit(0), F.lit(settings.bands - 1)), lambda i: F.struct(
        i.alias("band"), F.xxhash64(i, F.substring(F.col("sketch"), i * two + 1, F.lit(two))).alias("key")))
    members = classes.select("id", F.inline(keys))
    buckets = (members.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("hub"))
               .filter("size > 1"))
    shared = saved(members.join(buckets.select("key", "hub"), "key"), "buckets")
    sets = saved(set_table(docs, shared.select("id").distinct(), settings), "sets")

    stars = shared.filter("id > hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    first = saved(confirmed(stars, classes, sets, settings), "links")

    grouped = saved(components(first), "groups")
    labelled = (shared.select("key", "band", "id").join(grouped, "id", "left")
                .withColumn("component", F.coalesce("component", "id")))
    pairs, large = _across(labelled, settings)
    large = saved(large.select("key", "band", "id"), "large")
    grouped = saved(_widened(grouped, confirmed(pairs.distinct(), classes, sets, settings)), "groups")
    if large.isEmpty():
        return grouped
    links = saved(_links_of_large(large, grouped, classes, sets, settings).distinct(), "links")
    return saved(_widened(grouped, links), "groups")


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id (least id reachable over links), kept: one row per row."""
    sketched = saved(sketch_table(docs, settings), "sketches")
    identity = ["n_shingles", "set_a", "set_b"]
    known = sketched.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = saved(known.groupBy(*identity).agg(F.min("doc_id").alias("id"), F.first("sketch").alias("sketch"))
                    .select(F.col("n_shingles").alias("n"), "set_a", "set_b", "id", "sketch"), "classes")
    grouped = grouped_classes(docs, classes, settings)
    named = (classes.select(F.col("n").alias("n_shingles"), "set_a", "set_b", "id").join(grouped, "id", "left")
             .select(*identity, F.coalesce("component", "id").alias("component_id")))
    rows = sketched.drop("sketch").join(named, identity, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"),
                       component.eqNullSafe(F.col("doc_id")).alias("kept"))


def representatives(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` without the documents that :func:`near_duplicates` does not keep.

    The dropped ids are a narrow table that is hashed; the texts stream past
    it. Rows that repeat an id stay or go together; null ids stay.
    """
    dropped = near_duplicates(docs, settings).filter("NOT kept").select(F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(dropped.hint("shuffle_hash"), F.col("doc_id") == F.col("_dropped"), "left_anti")
