"""Vector code compression: product codebooks fitted by member-resident Lloyd rounds.

A component x becomes the integer floor(``scale`` * x); a vector is cut into
``parts`` consecutive parts, and each part position has a codebook of up to
``entries`` integer entries. Fitting keeps the members of an entry together:

1. Every part is assigned to its nearest entry of the first codebooks and
   shuffled once, by (position, entry, salt), to its owner. The table written
   there (generation 0) is where it resides.
2. Owners sum their resident members; the sums of the salts of an entry are
   added up (one row per entry and task) and give the next codebooks.
3. Owners compare their residents with the next codebooks. Only the parts that
   change entry are shuffled, to their new owner's next generation; the
   others stay in the file they are in. A row is resident in generation g as
   long as every codebook since prefers the entry it was written under, so
   leavers need no rewrite.

Members travel in blocks: one row per owner and Arrow batch with the packed
parts (the narrowest of 8, 16, 32 bits). The salt, a hash of the vector id,
splits an entry over enough owners that one holding a third of all rows is no
larger than an average shuffle partition. Codebooks and counts
(``parts`` x ``entries`` rows) are all that the driver sees.

Encoding is one scan without a shuffle: the final codebooks are broadcast and
each row's nearest entries give code and error.

Cases: rows that :mod:`.vectors` does not count are dropped. An empty table gives no rows. Null ids
are ordinary rows that come last in the choice of first entries; repeated ids are
separate rows, ordered by their vectors. With fewer than ``entries`` rows the
codebooks are smaller. Where ``parts`` does not divide the dimension the first parts
are one longer; with fewer components than parts there is one part per component.
Integers saturate at 2**24 on either side, so that errors stay exact in a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, mix, saved
from .vectors import dimension, matrix_of, usable

LIMIT = 1 << 24
BATCH_ROWS = 1 << 15


@dataclass(frozen=True)
class Settings:
    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: float = 256.0
    broadcast_labels: int = 100_000  # label totals up to this many rows are broadcast


@dataclass(frozen=True)
class Codebooks:
    """``cuts``: part borders; ``entries``: one integer matrix (entry, component) per part."""

    cuts: tuple[int, ...]
    scale: float = 256.0
    entries: list[np.ndarray] = field(default_factory=list)

    @property
    def size(self) -> int:
        return self.cuts[-1]

    def integers(self, values: np.ndarray) -> np.ndarray:
        return np.clip(np.floor(values * self.scale), -LIMIT, LIMIT).astype(np.int64)

    def listed(self) -> str:
        """All components by part, entry and position within the part."""
        return ",".join(str(v) for book in self.entries for v in book.reshape(-1).tolist())


def cuts_of(size: int, parts: int) -> tuple[int, ...]:
    parts = min(parts, size)
    short, longer = divmod(size, parts)
    return tuple(np.cumsum([0] + [short + (i < longer) for i in range(parts)]).tolist())


def nearest(members: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each integer row; ties go to the lower entry."""
    largest = max(int(np.abs(members).max(initial=0)), int(np.abs(book).max(initial=0)))
    if 4 * largest * largest * book.shape[1] < 1 << 53:
        # Every term is an integer below 2**53, so doubles are exact.
        x, c = members.astype(np.float64), book.astype(np.float64)
        distance = (c * c).sum(1) - 2.0 * (x @ c.T)
        entry = distance.argmin(axis=1)
        best = distance[np.arange(len(x)), entry] + (x * x).sum(1)
        return entry, best.astype(np.int64)
    entry = np.zeros(len(members), np.int64)
    best = np.full(len(members), np.iinfo(np.int64).max)
    for number, row in enumerate(book):
        distance = ((members - row) ** 2).sum(axis=1)
        closer = distance < best
        entry[closer], best[closer] = number, distance[closer]
    return entry, best


# --- blocks of members --------------------------------------------------------------------

_BLOCK = pa.schema([("position", pa.int32()), ("entry", pa.int32()), ("salt", pa.int32()), ("width", pa.int32()),
                    ("keys", pa.binary()), ("members", pa.binary())])
_BLOCK_DDL = "position int, entry int, salt int, width int, keys binary, members binary"


def _blocks(position: int, keys: np.ndarray, members: np.ndarray, entry: np.ndarray,
            salts: int) -> dict[str, list]:
    """The members of one position as one block per (entry, salt)."""
    salt = (keys % np.uint32(salts)).astype(np.int64)
    owner = entry * salts + salt
    order = np.argsort(owner, kind="stable")
    owner, keys, members = owner[order], keys[order], members[order]
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    bounds = [*starts.tolist(), len(owner)]
    out: dict[str, list] = {name: [] for name in _BLOCK.names}
    for a, b in zip(bounds, bounds[1:], strict=False):
        rows = members[a:b]
        largest = max(-int(rows.min()), int(rows.max()) + 1)
        width = 1 if largest <= 1 << 7 else 2 if largest <= 1 << 15 else 4
        out["position"].append(position)
        out["entry"].append(int(owner[a]) // salts)
        out["salt"].append(int(owner[a]) % salts)
        out["width"].append(width)
        out["keys"].append(keys[a:b].tobytes())
        out["members"].append(rows.astype(f"<i{width}").tobytes())
    return out


def _residents(batch: pa.RecordBatch, cuts: tuple[int, ...]
               ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(position, entry, keys, integer members) of each block."""
    columns = [batch.column(name).to_pylist() for name in ("position", "entry", "width", "keys", "members")]
    for position, entry, width, keys, members in zip(*columns, strict=True):
        rows = np.frombuffer(members, f"<i{width}").reshape(-1, cuts[position + 1] - cuts[position])
        yield position, entry, np.frombuffer(keys, np.uint32), rows.astype(np.int64)


def _settle(blocks: DataFrame, name: str) -> DataFrame:
    """Move blocks to their owners; the written table is where they reside."""
    return saved(blocks.repartition("position", "entry", "salt"), name)


def _salt_count(df: DataFrame, parts: int) -> int:
    """Owners per entry: a third of a position's rows on one entry, split into them,
    is no more than an average shuffle partition."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-partitions // (2 * parts)))


# --- fitting ------------------------------------------------------------------------------

def first_codebooks(rows: DataFrame, vec_id: str, vector: str, size: int, settings: Settings) -> Codebooks:
    """The parts of the rows with the least ids; bounded by ``entries`` rows."""
    least = (rows.filter(usable(vector) & (F.size(vector) == size)).select(vec_id, vector)
             .orderBy(F.col(vec_id).asc_nulls_last(), F.col(vector)).limit(settings.entries).collect())
    books = Codebooks(cuts_of(size, settings.parts), settings.scale)
    first = books.integers(np.array([r[1] for r in least], np.float64).reshape(-1, size))
    cuts = books.cuts
    return Codebooks(cuts, settings.scale, [first[:, a:b].copy() for a, b in zip(cuts, cuts[1:], strict=False)])


def _arrivals(rows: DataFrame, vec_id: str, vector: str, books: Codebooks, salts: int) -> DataFrame:
    """Generation 0: every part, under its nearest entry of the first codebooks."""
    schema = _BLOCK

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_ROWS):
                piece = batch.slice(first, BATCH_ROWS)
                kept, values = matrix_of(piece.column("vector"), books.size)
                if not len(kept):
                    continue
                whole = books.integers(values)
                keys = piece.column("key").to_numpy(zero_copy_only=False)[kept].astype(np.int64)
                keys = (mix(keys.view(np.uint64)) >> np.uint64(32)).astype(np.uint32)
                for position, book in enumerate(books.entries):
                    members = whole[:, books.cuts[position]:books.cuts[position + 1]]
                    entry, _ = nearest(members, book)
                    yield batch_of(_blocks(position, keys, members, entry, salts), schema)

    keyed = rows.select(F.xxhash64(vec_id).alias("key"), F.col(vector).alias("vector"))
    return keyed.mapInArrow(assigned, _BLOCK_DDL)


def _live(position: int, entry: int, members: np.ndarray, since: list[Codebooks]) -> np.ndarray:
    """Which residents every codebook since their arrival has left under ``entry``."""
    still = np.ones(len(members), bool)
    for books in since:
        still[still] = nearest(members[still], books.entries[position])[0] == entry
    return still


def _leavers(generations: list[DataFrame], history: list[Codebooks], salts: int) -> DataFrame:
    """The residents that the newest codebooks assign elsewhere, as blocks of their new owners."""
    newest, cuts = history[-1], history[-1].cuts

    def leaving_of(since: list[Codebooks]):
        def leaving(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for position, entry, keys, members in _residents(batch, cuts):
                    still = _live(position, entry, members, since)
                    keys, members = keys[still], members[still]
                    wanted, _ = nearest(members, newest.entries[position])
                    moves = wanted != entry
                    if moves.any():
                        yield batch_of(_blocks(position, keys[moves], members[moves], wanted[moves], salts), _BLOCK)
        return leaving

    moved = None
    for g, generation in enumerate(generations):
        part = generation.mapInArrow(leaving_of(history[g + 1:-1]), _BLOCK_DDL)
        moved = part if moved is None else moved.unionByName(part)
    return moved


def _updated(generations: list[DataFrame], history: list[Codebooks]) -> Codebooks:
    """The next codebooks: floor of the mean of each entry's residents; unused entries stay."""
    newest, cuts = history[-1], history[-1].cuts
    schema = pa.schema([("position", pa.int32()), ("entry", pa.int32()), ("component", pa.int32()),
                        ("total", pa.int64()), ("members", pa.int64())])

    def summed_of(since: list[Codebooks]):
        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals: dict[tuple[int, int], list] = {}
            for batch in batches:
                for position, entry, _, members in _residents(batch, cuts):
                    still = members[_live(position, entry, members, since)]
                    have = totals.setdefault((position, entry), [0, 0])
                    have[0] = have[0] + still.sum(axis=0)
                    have[1] += len(still)
            rows = [(p, e, i, int(v), n) for (p, e), (total, n) in totals.items() if n
                    for i, v in enumerate(total)]
            if rows:
                yield batch_of(dict(zip(schema.names, map(list, zip(*rows, strict=True)), strict=True)), schema)
        return summed

    sums = None
    for g, generation in enumerate(generations):
        part = generation.mapInArrow(summed_of(history[g + 1:]),
                                     "position int, entry int, component int, total long, members long")
        sums = part if sums is None else sums.unionByName(part)
    # At most one row per component of a codebook reaches the driver.
    entries = [book.copy() for book in newest.entries]
    for r in (sums.groupBy("position", "entry", "component")
              .agg(F.sum("total").alias("total"), F.sum("members").alias("members")).collect()):
        entries[r["position"]][r["entry"], r["component"]] = r["total"] // r["members"]
    return Codebooks(cuts, newest.scale, entries)


def fit(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
        settings: Settings = Settings()) -> Codebooks | None:
    """Codebooks of ``rows``; None without a usable vector."""
    size = dimension(rows, vector)
    if size is None:
        return None
    salts = _salt_count(rows, settings.parts)
    history = [first_codebooks(rows, vec_id, vector, size, settings)]
    if not settings.rounds:
        return history[0]
    generations = [_settle(_arrivals(rows, vec_id, vector, history[0], salts), "codebook-members")]
    history.append(_updated(generations, history))
    for _ in range(settings.rounds - 1):
        generations.append(_settle(_leavers(generations, history, salts), "codebook-members"))
        history.append(_updated(generations, history))
    return history[-1]


# --- encoding -----------------------------------------------------------------------------

def encode(rows: DataFrame, books: Codebooks, vector: str = "embedding") -> DataFrame:
    """The usable ``rows`` without ``vector``, with ``code`` and ``error``.

    Columns of these names in ``rows`` are replaced.
    """
    shared = rows.sparkSession.sparkContext.broadcast(books)
    kept = [c for c in rows.columns if c not in (vector, "code", "error")]
    renamed = rows.select(*kept, F.col(vector).alias("code"))
    types = {f.name: f.dataType.simpleString() for f in renamed.schema}
    ddl = ", ".join([*(f"`{c}` {types[c]}" for c in kept), "`code` string", "`error` bigint"])
    hexed = np.array([f"{i:02x}" for i in range(max(map(len, books.entries), default=0))], object)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        final = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_ROWS):
                piece = batch.slice(first, BATCH_ROWS)
                at, values = matrix_of(piece.column("code"), final.size)
                whole = final.integers(values)
                codes, error = np.full(len(at), "", object), np.zeros(len(at), np.int64)
                for position, book in enumerate(final.entries):
                    entry, distance = nearest(whole[:, final.cuts[position]:final.cuts[position + 1]], book)
                    codes += hexed[entry]
                    error += distance
                others = [piece.column(c).take(pa.array(at)) for c in kept]
                yield pa.RecordBatch.from_arrays(
                    [*others, pa.array(codes, pa.string()), pa.array(error)], names=[*kept, "code", "error"])

    return renamed.mapInArrow(encoded, ddl)


def with_label_error(encoded: DataFrame, label: str = "label", settings: Settings = Settings()) -> DataFrame:
    """``encoded`` with the error summed over rows of equal label (nulls together).

    The totals are combined map-side. Up to ``broadcast_labels`` of them are
    broadcast; beyond, they are copied once per salt, so that a hot label's rows
    spread over as many tasks.
    """
    spark = encoded.sparkSession
    totals = saved(encoded.groupBy(F.col(label).alias("_label")).agg(F.sum("error").alias("label_error")),
                   "codebook-labels")
    if totals.count() <= settings.broadcast_labels:
        joined = encoded.join(F.broadcast(totals), F.col(label).eqNullSafe(F.col("_label")))
        return joined.drop("_label")
    salts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    copies = totals.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = encoded.withColumn("_own", F.pmod(F.xxhash64(*encoded.columns), F.lit(salts)).cast("int"))
    joined = salted.join(copies, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_own") == F.col("_salt")))
    return joined.drop("_label", "_salt", "_own")


def compress(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
             settings: Settings = Settings()) -> DataFrame:
    """Id, label, code, error, label_error and the hash of the codebooks for every usable row."""
    books = fit(rows.select(vec_id, vector), vec_id, vector, settings)
    narrow = rows.select(vec_id, label, vector)
    if books is None:
        empty = narrow.limit(0).drop(vector)
        return (empty.withColumn("code", F.lit("")).withColumn("error", F.lit(0).cast("long"))
                .withColumn("label_error", F.lit(0).cast("long")).withColumn("codebooks_sha256", F.lit("")))
    coded = saved(encode(narrow, books, vector), "codebook-codes")
    return (with_label_error(coded, label, settings)
            .withColumn("codebooks_sha256", F.sha2(F.lit(books.listed()).cast("binary"), 256)))
