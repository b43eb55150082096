"""Toxicity scores: FTRL-proximal logistic regression on hashed word features.

Features of a text are the distinct hashes, into ``2**bits`` slots, of its
words (A-Z lower-cased; ASCII punctuation and white space separate), word
pairs and one-word skip pairs. Training is online FTRL-proximal: every
coordinate has its own rate ``alpha / (beta + sqrt(n))`` and is exactly zero
until its accumulated gradient exceeds ``l1``, so the model is a short list
of weights that is broadcast to the scoring tasks. Scores read the text only.

Training uses a bounded sample: at most about ``max_train`` labelled rows
(:class:`Settings`), taken by a hash of the id whatever the table's size.
Scoring covers every row and whole texts, with no shuffle.

Cases: a null text is an empty text; an empty text scores the learned prior.
Without usable labels the model is empty and every score is 0.5 ** 3. Null or
conflicting labels: nulls are left out, an id labelled both ways counts as
toxic. Repeated rows score alike. Ids may be null (never trained on, held out
false).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, batch_of, byte_slices, ordered_hash, text_or_empty, word_hashes, words


@dataclass(frozen=True)
class Settings:
    """Model parameters; ``max_train`` bounds the training sample (rows, about)."""

    bits: int = 22
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.1
    epochs: int = 4
    max_train: int = 24_000
    threshold: float = 0.3


@dataclass(frozen=True)
class Model:
    """Sparse weights: slot numbers (ascending) and values, and the bias."""

    bits: int
    bias: float
    slots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    values: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))

    def dense(self) -> np.ndarray:
        weights = np.zeros(1 << self.bits, np.float32)
        weights[self.slots] = self.values
        return weights


NO_LABELS_BIAS = float(np.log(0.125 / 0.875))

# Separators: ASCII other than letters, digits and the apostrophe.
_BREAK = np.array([i < 128 and not (chr(i).isalnum() or chr(i) == "'") for i in range(256)])


def slots_of(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, slot) of every word, pair and skip pair; repeats included."""
    start, end, row = words(data, offsets, _BREAK)
    one = word_hashes(data, start, end)
    rows, hashes = [row], [ordered_hash([one], 1)]
    for gap, tag in ((1, 2), (2, 3)):
        same = np.flatnonzero(row[gap:] == row[:-gap]) if len(row) > gap else np.zeros(0, np.int64)
        rows.append(row[same])
        hashes.append(ordered_hash([one[same], one[same + gap]], tag))
    return np.concatenate(rows), (np.concatenate(hashes) >> U64(64 - bits)).astype(np.int64)


def _distinct(row: np.ndarray, slot: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.unique((row << bits) | slot)
    return keys >> bits, keys & ((1 << bits) - 1)


def _sigmoid(x: np.ndarray | float) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def train(examples: list[tuple[np.ndarray, int]], settings: Settings) -> Model:
    """Fit on (distinct slots, label) examples, in the given order."""
    if not examples:
        return Model(settings.bits, NO_LABELS_BIAS)
    z, n = np.zeros(1 << settings.bits), np.zeros(1 << settings.bits)
    toxic = (sum(y for _, y in examples) + 0.5) / (len(examples) + 1)
    bias, bias_n = float(np.log(toxic / (1 - toxic))), 0.0

    def weights(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zs) * settings.l1 - zs
        return np.where(np.abs(zs) > settings.l1,
                        shrunk / ((settings.beta + np.sqrt(ns)) / settings.alpha + settings.l2), 0.0)

    order = np.random.Generator(np.random.PCG64(7))
    for _ in range(settings.epochs):
        for i in order.permutation(len(examples)):
            slots, label = examples[i]
            zs, ns = z[slots], n[slots]
            w = weights(zs, ns)
            gradient = float(_sigmoid(bias + w.sum())) - label
            square = gradient * gradient
            rate = (np.sqrt(ns + square) - np.sqrt(ns)) / settings.alpha
            z[slots] = zs + gradient - rate * w
            n[slots] = ns + square
            bias_n += square
            bias -= settings.alpha * 0.1 / (settings.beta + np.sqrt(bias_n)) * gradient
    w = weights(z, n)
    slots = np.flatnonzero(w)
    return Model(settings.bits, bias, slots, w[slots].astype(np.float32))


# --- Spark -----------------------------------------------------------------------------

def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True where crc32 of the id as text leaves 2 modulo 4 (null: false)."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Train on labelled documents that are not held out.

    The labels (ids only) are counted and thinned by an id hash to about
    ``max_train`` before the texts are touched; the thinned ids, bounded by
    the parameter, are broadcast to the one scan of the texts.
    """
    known = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")))
    share = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)
    total = known.count()
    if total == 0:
        return Model(settings.bits, NO_LABELS_BIAS)
    chosen = known.filter(share < F.lit(settings.max_train / total))
    texts = (docs.select("doc_id", text_or_empty("text").alias("text"))
             .join(F.broadcast(chosen), "doc_id"))
    bits = settings.bits
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("slots", pa.list_(pa.int32()))])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in byte_slices(batch.column("text")):
                row, slot = _distinct(*slots_of(data, offsets, bits), bits)
                at = np.searchsorted(row, np.arange(end - first + 1)).astype(np.int32)
                yield batch_of({
                    "doc_id": batch.column("doc_id").slice(first, end - first),
                    "toxic": batch.column("toxic").slice(first, end - first),
                    "slots": pa.ListArray.from_arrays(pa.array(at), pa.array(slot.astype(np.int32))),
                }, schema)

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, int] = {}
        for batch in batches:
            column = batch.column("slots")
            offsets = column.offsets.to_numpy()
            values = column.values.to_numpy()
            for i, (doc_id, toxic) in enumerate(zip(batch.column("doc_id").to_pylist(),
                                                    batch.column("toxic").to_pylist(), strict=True)):
                seen[(doc_id, values[offsets[i]:offsets[i + 1]].tobytes())] = toxic
        examples = [(np.frombuffer(slots, np.int32), toxic) for (_, slots), toxic in sorted(seen.items())]
        model = train(examples, settings)
        yield pa.RecordBatch.from_pydict({
            "bias": [model.bias], "slots": [model.slots.tolist()], "values": [model.values.tolist()]},
            pa.schema([("bias", pa.float64()), ("slots", pa.list_(pa.int64())), ("values", pa.list_(pa.float32()))]))

    # The sample is bounded, so one task fits it; a lost executor only repeats the task.
    row = (texts.mapInArrow(hashed, "doc_id long, toxic int, slots array<int>")
           .repartition(1)
           .mapInArrow(fitted, "bias double, slots array<bigint>, values array<float>")).first()
    if row is None:
        return Model(settings.bits, NO_LABELS_BIAS)
    return Model(bits, row["bias"], np.array(row["slots"], np.int64), np.array(row["values"], np.float32))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the model's probability for each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = shared.value
        weights, bits = fitted.dense(), fitted.bits
        used = weights != 0
        for texts in batches:
            total = np.full(len(texts), fitted.bias)
            for first, end, data, offsets in byte_slices(texts):
                row, slot = slots_of(data, offsets, bits)
                hit = used[slot]
                row, slot = _distinct(row[hit], slot[hit], bits)
                total[first:end] += np.bincount(row, weights[slot], minlength=end - first)
            yield pa.array(_sigmoid(total))

    return docs.withColumn(out, scored(text_or_empty(text)))


def toxicity(docs: DataFrame, labelled: DataFrame, labels: DataFrame,
             settings: Settings = Settings()) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted``; fitted on ``labelled``."""
    model = fit(labelled, labels, settings)
    return (score(docs.withColumn("held_out", held_out()), model)
            .withColumn("predicted", (F.col("score") >= settings.threshold).cast("int")))


def accepted(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """The documents whose score stays under the threshold, columns unchanged."""
    columns = docs.columns
    return score(docs, model, out="_toxicity").filter(F.col("_toxicity") < settings.threshold).select(*columns)
