"""Document quality: a linear-chain conditional random field over the lines of a text.

Every line (a run of bytes between line feeds) is described by binned measures of
its own surface (shares of letters, capitals, digits, signs, repeated bytes and
repeated words, word lengths, how it begins and ends, whether it repeats elsewhere in
the document) and by the same measures of the line before and the line after. The
field labels each line good or bad: node potentials are weights of these features,
chain potentials tie neighbouring lines. Forward and backward messages give each
line's probability of being good, and a document's score is their mean, weighted
by the visible characters of each line.

Labels are known for documents only. Training first gives every line its
document's label; then lines of a bad document that look good by themselves are
relabelled (as long as most of it stays bad), and the field is fitted again by
gradient ascent on the likelihood of the line labels.

Messages are prefix products of 2 x 2 matrices, computed by doubling over
all lines of a slice at once: a line that begins a document has equal rows and so
forgets what went before. Long documents need more doublings, not more Python.

Training uses a bounded sample of about ``max_train`` labelled documents, taken by a
hash of the id, of which only the bins (one byte a measure and line) are
shuffled; one task fits it. Scoring is one scan without a shuffle that reads the text only.

Cases: a null text is an empty text; a text without visible characters scores the
share of good documents in the sample. Without usable labels every score is 0.5. Null
labels are left out; an id labelled both ways counts as bad. Repeated rows score
alike. Ids may be null (never trained on, held out false).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, batch_of, byte_slices, mix, text_or_empty, word_hashes, words


@dataclass(frozen=True)
class Settings:
    """``max_train`` bounds the training sample (documents, about)."""

    max_train: int = 6_000
    iterations: int = 60
    rate: float = 0.3
    l2: float = 1.0
    chain_l2: float = 20.0
    relabel: float = 0.9
    threshold: float = 0.5


BINS = 16
# Borders of the bins of shares and of counts.
_SHARES = np.array([1e-9, 0.01, 0.03, 0.06, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.65, 0.8, 0.9, 0.99])
_COUNTS = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 48, 96, 192, 384, 1536])
_LENGTHS = np.array([1.5, 2, 2.5, 3, 3.5, 4, 4.5, 5, 6, 7, 8, 10, 14, 20])


def _mask(*chosen: str | range) -> np.ndarray:
    out = np.zeros(256, bool)
    for part in chosen:
        out[[ord(c) for c in part] if isinstance(part, str) else list(part)] = True
    return out


_UPPER = _mask(range(65, 91))
_LETTER = _mask(range(65, 91), range(97, 123), range(128, 256))
_DIGIT = _mask(range(48, 58))
_WHITE = _mask(" ", range(9, 14))
_CLAUSE = _mask(".,;:")
_SHOUT = _mask("!?")
_BAR = _mask("|\t")
_SIGN = _mask("#$%&*@^~=+<>\\/_{}[]`")
_STOP = _mask(".!?:\"')")
_SKIP_FEED = _mask("\n")
#: Continuation bytes do not begin a code point.
_INNER = _mask(range(0x80, 0xC0))

MEASURES = ("letters", "capitals", "digits", "clauses", "shouts", "bars", "signs", "doubled", "echoes", "variety",
            "word_length", "longest", "words", "edges", "copies")
WIDTH = len(MEASURES)
#: Own bins, those of the line before, and those of the line after.
SLOTS = 3 * WIDTH


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, visible characters, bins by measure) of every line of the slice's texts."""
    start, end, row = words(data, offsets, _SKIP_FEED)
    if not len(start):
        return row, np.zeros(0, np.int64), np.zeros((0, WIDTH), np.uint8)

    def sums(mask: np.ndarray) -> np.ndarray:
        running = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return running[end] - running[start]

    visible = sums(~(_WHITE | _INNER)[data])
    solid = np.maximum(sums(~_WHITE[data]), 1)
    letters, capitals = sums(_LETTER[data]), sums(_UPPER[data])
    doubled = np.zeros(len(data), bool)
    doubled[1:] = (data[1:] == data[:-1]) & ~_WHITE[data[1:]]

    # Words of each line: their number, lengths, neighbours that are equal, and distinct ones.
    first, last, _ = words(data, offsets)
    line = np.searchsorted(start, first, "right") - 1
    codes = word_hashes(data, first, last)
    n_words = np.bincount(line, minlength=len(start))
    some = np.maximum(n_words, 1)
    echo = np.zeros(len(first), bool)
    echo[1:] = (codes[1:] == codes[:-1]) & (line[1:] == line[:-1])
    echoes = np.bincount(line[echo], minlength=len(start)) / np.maximum(some - 1, 1)
    order = np.lexsort((codes, line))
    fresh = np.ones(len(first), bool)
    fresh[1:] = (codes[order][1:] != codes[order][:-1]) | (line[order][1:] != line[order][:-1])
    variety = np.bincount(line[order][fresh], minlength=len(start)) / some
    longest = np.zeros(len(start), np.int64)
    np.maximum.at(longest, line, last - first)

    # How a line begins (capital, other letter, else) and ends (stop, other letter, else).
    a, z = data[start], data[end - 1]
    edges = 3 * np.where(_UPPER[a] | (a == 0xC3), 0, np.where(_LETTER[a], 1, 2)) \
        + np.where(_STOP[z], 0, np.where(_LETTER[z], 1, 2))

    # Copies of a line in its document: none, elsewhere, or right before.
    whole = mix(word_hashes(data, start, end) ^ (row.astype(U64) * U64(0x9E3779B97F4A7C15)))
    _, back, times = np.unique(whole, return_inverse=True, return_counts=True)
    copies = (times[back] > 1).astype(np.int64)
    copies[1:] += (whole[1:] == whole[:-1])

    def share(x: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.digitize(x / np.maximum(of, 1), _SHARES)

    bins = [share(letters, solid), share(capitals, letters), share(sums(_DIGIT[data]), solid),
            share(sums(_CLAUSE[data]), solid), share(sums(_SHOUT[data]), solid), share(sums(_BAR[data]), solid),
            share(sums(_SIGN[data]), solid), share(sums(doubled), solid), np.digitize(echoes, _SHARES),
            np.digitize(variety, _SHARES), np.digitize(visible / some, _LENGTHS), np.digitize(longest, _COUNTS),
            np.digitize(n_words, _COUNTS), edges, copies]
    return row, visible, np.stack(bins, axis=1).astype(np.uint8)


def _begins(row: np.ndarray) -> np.ndarray:
    out = np.ones(len(row), bool)
    out[1:] = row[1:] != row[:-1]
    return out


def slots_of(row: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Feature numbers of each line: own bins and its neighbours' (a bin of their own at a document's ends)."""
    begins = _begins(row)
    ends = np.append(begins[1:], True) if len(row) else begins
    before, after = np.empty_like(bins), np.empty_like(bins)
    before[1:], after[:-1] = bins[:-1], bins[1:]
    before[begins], after[ends] = BINS - 1, BINS - 1
    return np.hstack([bins, before, after]).astype(np.int32) + np.arange(SLOTS, dtype=np.int32) * BINS


# --- the field --------------------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    """``node``: log odds of good by feature; ``chain``: log potential of (label, next label); bad is 0."""

    prior: float = 0.5
    node: np.ndarray = field(default_factory=lambda: np.zeros(SLOTS * BINS))
    chain: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def potentials(self, slots: np.ndarray) -> np.ndarray:
        return self.node[slots].sum(axis=1)


def _products(matrices: np.ndarray, longest: int) -> np.ndarray:
    """Row vectors of the running products; ``longest``: lines of the longest document."""
    run = matrices / matrices.max(axis=(1, 2), keepdims=True)
    step = 1
    while step < longest:
        joined = np.matmul(run[:-step], run[step:])
        run = np.concatenate([run[:step], joined / joined.max(axis=(1, 2), keepdims=True)])
        step *= 2
    return run


def messages(row: np.ndarray, node: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(probability of good by line, joint probabilities of the labels of each line and the next).

    The joint probabilities of a document's last line are zero.
    """
    n = len(row)
    if not n:
        return np.zeros(0), np.zeros((0, 2, 2))
    begins = _begins(row)
    ends = np.append(begins[1:], True)
    starts = np.flatnonzero(begins)
    longest = int(np.diff(np.append(starts, n)).max())
    clipped = np.clip(node, -30.0, 30.0)
    local = np.stack([np.ones(n), np.exp(clipped)], axis=1)
    local /= local.sum(axis=1, keepdims=True)
    tie = np.exp(chain - chain.max())
    ahead = tie[None] * local[:, None, :]
    ahead[begins] = local[begins][:, None, :]
    forward = _products(ahead, longest)[:, 0, :]
    back = np.ones((n, 2, 2))
    back[~ends] = tie[None] * local[np.flatnonzero(~ends) + 1][:, None, :]
    # Suffix products of the reversed, transposed matrices are prefix products.
    backward = _products(back[::-1].transpose(0, 2, 1), longest)[::-1].transpose(0, 2, 1).sum(axis=2)
    both = forward * backward
    good = both[:, 1] / both.sum(axis=1)
    joint = np.zeros((n, 2, 2))
    at = np.flatnonzero(~ends)
    pairs = forward[at][:, :, None] * tie[None] * (local[at + 1] * backward[at + 1])[:, None, :]
    joint[at] = pairs / pairs.sum(axis=(1, 2), keepdims=True)
    return good, joint


def _ascend(row: np.ndarray, slots: np.ndarray, label: np.ndarray, settings: Settings) -> Model:
    """Likelihood ascent with per-coordinate rates over all lines."""
    node, chain = np.zeros(SLOTS * BINS), np.zeros((2, 2))
    squares = [np.full(node.shape, 1e-6), np.full(chain.shape, 1e-6)]
    ends = np.append(_begins(row)[1:], True)
    left, right = label[:-1][~ends[:-1]], label[1:][~ends[:-1]]
    seen = np.bincount(2 * left + right, minlength=4).reshape(2, 2)
    flat = slots.reshape(-1)
    for _ in range(settings.iterations):
        good, joint = messages(row, node[slots].sum(axis=1), chain)
        gradients = [np.bincount(flat, np.repeat(label - good, SLOTS), minlength=len(node)) - settings.l2 * node,
                     seen - joint.sum(axis=0) - settings.chain_l2 * chain]
        for weights, gradient, square in zip((node, chain), gradients, squares, strict=True):
            square += gradient * gradient
            weights += settings.rate * gradient / np.sqrt(square)
    return Model(0.5, node, chain)


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings = Settings()) -> Model:
    """Fit on (bins, visible characters, document label) examples, in the given order."""
    if not examples:
        return Model()
    prior = (sum(y for *_, y in examples) + 0.5) / (len(examples) + 1)
    row = np.repeat(np.arange(len(examples)), [len(b) for b, *_ in examples])
    if not len(row):
        return Model(prior)
    bins = np.concatenate([b for b, *_ in examples])
    length = np.concatenate([v for _, v, _ in examples])
    label = np.array([y for *_, y in examples])[row]
    slots = slots_of(row, bins)
    first = _ascend(row, slots, label, settings)
    # Lines of bad documents that look good by themselves, where most of the document stays bad.
    alone = 1 / (1 + np.exp(-np.clip(first.potentials(slots), -30, 30)))
    spared = (label == 0) & (alone >= settings.relabel)
    share = np.bincount(row, length * spared, len(examples)) / np.maximum(np.bincount(row, length, len(examples)), 1)
    label = np.where(spared & (share < 0.5)[row], 1, label)
    fitted = _ascend(row, slots, label, settings)
    return Model(prior, fitted.node, fitted.chain)


def line_scores(data: np.ndarray, offsets: np.ndarray, model: Model
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, visible characters, probability of good) of every line."""
    row, visible, bins = lines_of(data, offsets)
    good, _ = messages(row, model.potentials(slots_of(row, bins)), model.chain)
    return row, visible, good


def document_scores(data: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    """The length-weighted mean of each text's lines; the prior where nothing is visible."""
    row, visible, good = line_scores(data, offsets, model)
    rows = len(offsets) - 1
    weight = np.bincount(row, visible, rows)
    total = np.bincount(row, visible * good, rows)
    return np.clip(np.where(weight > 0, total / np.maximum(weight, 1), model.prior), 0.0, 1.0)


# --- Spark -----------------------------------------------------------------------------

def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 1 modulo 3 (null: false)."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Train on labelled documents that are not held out.

    The labels are thinned by an id hash to about ``max_train`` before the texts are
    touched; the thinned ids, bounded by the parameter, are broadcast to the one scan.
    """
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.min((F.col("quality") > 0).cast("int")).alias("good")))
    share = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)
    total = known.count()
    if total == 0:
        return Model()
    chosen = known.filter(share < F.lit(settings.max_train / total))
    texts = docs.select("doc_id", text_or_empty("text").alias("text")).join(F.broadcast(chosen), "doc_id")
    schema = pa.schema([("doc_id", pa.int64()), ("good", pa.int32()), ("bins", pa.binary()), ("visible", pa.binary())])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in byte_slices(batch.column("text")):
                row, visible, bins = lines_of(data, offsets)
                cuts = np.searchsorted(row, np.arange(end - first + 1)).tolist()
                spans = list(zip(cuts, cuts[1:], strict=False))
                yield batch_of({
                    "doc_id": batch.column("doc_id").slice(first, end - first).cast(pa.int64()),
                    "good": batch.column("good").slice(first, end - first),
                    "bins": [bins[a:b].tobytes() for a, b in spans],
                    "visible": [visible[a:b].astype("<u4").tobytes() for a, b in spans]}, schema)

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            seen.update(zip(*(batch.column(n).to_pylist() for n in schema.names), strict=True))
        model = train([(np.frombuffer(bins, np.uint8).reshape(-1, WIDTH), np.frombuffer(visible, "<u4").astype(np.int64),
                        good) for _, good, bins, visible in sorted(seen)], settings)
        yield pa.RecordBatch.from_pydict({"prior": [model.prior], "node": [model.node.tolist()],
                                          "chain": [model.chain.reshape(-1).tolist()]})

    # The sample is bounded, so one task fits it; a lost executor only repeats the task.
    found = (texts.mapInArrow(measured, "doc_id long, good int, bins binary, visible binary")
             .repartition(1)
             .mapInArrow(fitted, "prior double, node array<double>, chain array<double>")).first()
    if found is None:
        return Model()
    return Model(found["prior"], np.array(found["node"]), np.array(found["chain"]).reshape(2, 2))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the document score of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = shared.value
        for texts in batches:
            result = np.full(len(texts), fitted.prior)
            for first, end, data, offsets in byte_slices(texts):
                result[first:end] = document_scores(data, offsets, fitted)
            yield pa.array(result)

    return docs.withColumn(out, scored(text_or_empty(text)))


def quality(docs: DataFrame, labelled: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``; fitted on ``labelled``."""
    model = fit(labelled, labels, settings)
    return (score(docs.withColumn("held_out", held_out()), model)
            .withColumn("predicted", (F.col("score") >= settings.threshold).cast("int")))
