"""Personal data: base patterns and a skip-chain conditional random field.

The base patterns find emails, IP addresses, cards and phones. Around them a
conditional random field labels every token that holds a digit or an ``@``
(others cannot be part of these kinds): node potentials over the token's
shape, length, checks and neighbours; chain potentials between tokens next
to each other; and skip potentials between distant tokens of a document that
are equal or share their digits, so that a repeated or partly repeated entity is
labelled alike wherever it stands. Loopy message passing gives marginals;
tokens of base spans are held at their label. Tokens outside them whose
label is at least ``threshold`` likely add spans; base spans always stay.

Equal tokens are linked to the next one only, so a document's graph is
linear in its tokens. Potentials are trained by pseudo-likelihood on a
bounded sample (``max_train`` documents, about, by a hash of the text) in which
the base spans give the labels; the skip potential starts from a prior that favours equal
labels, which decides where the sample has too few repeats. Finding is one scan without a shuffle.

Cases: null text is empty and has no spans. Null or repeated ids are ordinary
rows. An empty table trains an empty model, which adds nothing. Very long
texts and digit runs are searched in linear time.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_of, text_or_empty

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = len(KINDS)
LABELS = OUTSIDE + 1

# The base patterns. Look-behinds and possessive runs only
# stop searches that cannot succeed; an email's left part is read back from "@".
_EMAIL_LEFT = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL_RIGHT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MAYBE = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"\S*[0-9@]\S*")
_DIGITS = re.compile(r"[0-9]+")
_EDGE = ".,;:!?\"'()[]{}<>"


@dataclass(frozen=True)
class Settings:
    max_train: int = 6_000
    rounds: int = 150
    rate: float = 0.5
    l2: float = 1e-3
    agreement: float = 1.5  # prior of the skip potential where two linked tokens agree
    passes: int = 12
    damping: float = 0.5
    threshold: float = 0.9


# --- base patterns ------------------------------------------------------------------

def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start."""
    if not _MAYBE.search(text):
        return []
    out = []
    end = 0
    at = text.find("@")
    while at >= 0:
        right = _EMAIL_RIGHT.match(text, at)
        if right:
            start = at
            while start > end and text[start - 1] in _EMAIL_LEFT:
                start -= 1
            if start < at:
                end = right.end()
                out.append((0, start, end))
        at = text.find("@", max(at + 1, end))
    for m in _IP.finditer(text):
        if all(len(p) < 400 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((3, m.start(), m.end()))
    return out


# --- the field's graph ----------------------------------------------------------------

def _shape(token: str) -> str:
    """The token's runs of letters and digits and its signs; a long one in full, as a digest behind its beginning."""
    out = []
    for c in token:
        kind = "9" if "0" <= c <= "9" else "a" if c.isalpha() else c
        if not out or out[-1] != kind:
            out.append(kind)
    shape = "".join(out)
    return shape if len(out) <= 16 else f"{shape[:16]}~{zlib.crc32(shape.encode('utf-8', 'surrogatepass')):08x}"


def _features(text: str, start: int, end: int, before: str, after: str) -> list[str]:
    """``before`` and ``after``: shapes of the words next to the token, if they are tokens too."""
    token = text[start:end]
    core = token.strip(_EDGE)
    digits = sum(map(len, _DIGITS.findall(core)))
    parts = core.split(".")
    out = ["bias", f"shape={_shape(core)}", f"digits={min(digits, 20)}", f"length={min(len(core), 24) // 2}",
           f"kinds={''.join(sorted({'9' if '0' <= c <= '9' else 'a' if c.isalpha() else c for c in core}))}",
           f"lead={token[:1] if not token[:1].isalnum() else ''}", f"at={'@' in core}", f"dots={min(core.count('.'), 5)}",
           f"mixed={digits > 0 and any(c.isalpha() for c in core)}", f"before={before}", f"after={after}"]
    if len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 4 for p in parts):
        out.append(f"octets={all(int(p) <= 255 for p in parts)}")
    if 12 < digits < 20:
        out.append(f"luhn={luhn(''.join(_DIGITS.findall(core)))}")
    return out


@dataclass
class Graph:
    """Tokens of one text: place, features, held label (or -1), and edges."""

    places: list[tuple[int, int]]
    features: list[list[str]]
    held: np.ndarray
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


def graph_of(text: str, base: list[tuple[int, int, int]]) -> Graph:
    places = [m.span() for m in _TOKEN.finditer(text)]
    held = np.full(len(places), -1)
    starts = np.array([p[0] for p in places] or [0])
    ends = np.array([p[1] for p in places] or [0])
    for kind, start, end in base:
        first = int(np.searchsorted(ends[:len(places)], start, "right"))
        last = int(np.searchsorted(starts[:len(places)], end, "left"))
        held[first:last] = np.where(held[first:last] < 0, kind, held[first:last])
    chain = [(i, i + 1) for i in range(len(places) - 1)
             if places[i + 1][0] - places[i][1] == 1]
    skip, last_of = [], {}
    for i, (start, end) in enumerate(places):
        core = text[start:end].strip(_EDGE).lower()
        digits = "".join(_DIGITS.findall(core))
        for key in {("token", core), ("digits", digits)} if len(digits) >= 4 else {("token", core)}:
            if key in last_of and (last_of[key], i) not in skip[-2:]:
                skip.append((last_of[key], i))
            last_of[key] = i
    # Words with neither digit nor "@" say nothing here, so only a token next to a token has a neighbour.
    shapes = [_shape(text[a:b]) for a, b in places]
    near = [text[one[1]:two[0]].isspace() for one, two in zip(places, places[1:], strict=False)]
    before = ["", *(s if n else "" for s, n in zip(shapes, near, strict=False))]
    after = [*(s if n else "" for s, n in zip(shapes[1:], near, strict=True)), ""]
    return Graph(places, [_features(text, a, b, x, y) for (a, b), x, y in zip(places, before, after, strict=False)],
                 held, chain, skip)


@dataclass(frozen=True)
class Model:
    """Node weights by feature, chain weights (left, right label) and skip weights."""

    index: dict[str, int] = field(default_factory=dict)
    node: np.ndarray = field(default_factory=lambda: np.zeros((0, LABELS)))
    chain: np.ndarray = field(default_factory=lambda: np.zeros((LABELS, LABELS)))
    skip: np.ndarray = field(default_factory=lambda: np.zeros((LABELS, LABELS)))

    def potentials(self, graph: Graph) -> np.ndarray:
        out = np.zeros((len(graph.places), LABELS))
        for i, features in enumerate(graph.features):
            known = [self.index[f] for f in features if f in self.index]
            if known:
                out[i] = self.node[known].sum(axis=0)
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def train(graphs: list[Graph], settings: Settings) -> Model:
    """Pseudo-likelihood: each label given the token's features and its neighbours' labels."""
    graphs = [g for g in graphs if g.places]
    if not graphs:
        return Model()
    index: dict[str, int] = {}
    rows, columns, labels, chain, skip, base = [], [], [], [], [], 0
    for g in graphs:
        for i, features in enumerate(g.features):
            for f in features:
                rows.append(base + i)
                columns.append(index.setdefault(f, len(index)))
        labels.append(np.where(g.held < 0, OUTSIDE, g.held))
        chain += [(base + a, base + b) for a, b in g.chain]
        skip += [(base + a, base + b) for a, b in g.skip]
        base += len(g.places)
    row, column, y = np.array(rows), np.array(columns), np.concatenate(labels)
    left, right = (np.array(x, int).reshape(-1) for x in (zip(*chain, strict=True) if chain else ((), ())))
    one, two = (np.array(x, int).reshape(-1) for x in (zip(*skip, strict=True) if skip else ((), ())))
    truth = np.eye(LABELS)[y]
    prior = [np.zeros((len(index), LABELS)), np.zeros((LABELS, LABELS)), settings.agreement * np.eye(LABELS)]
    weights = [p.copy() for p in prior]
    squares = [np.full_like(w, 1e-6) for w in weights]
    for _ in range(settings.rounds):
        node, chained, skipped = weights
        score = np.zeros((base, LABELS))
        np.add.at(score, row, node[column])
        np.add.at(score, right, chained[y[left]])
        np.add.at(score, left, chained[:, y[right]].T)
        np.add.at(score, two, skipped[y[one]])
        np.add.at(score, one, skipped[:, y[two]].T)
        error = (_softmax(score) - truth) / base
        gradients = [np.zeros_like(w) for w in weights]
        np.add.at(gradients[0], column, error[row])
        np.add.at(gradients[1], y[left], error[right])
        np.add.at(gradients[1].T, y[right], error[left])
        np.add.at(gradients[2], y[one], error[two])
        np.add.at(gradients[2].T, y[two], error[one])
        gradients[2] = (gradients[2] + gradients[2].T) / 2
        for w, p, g, s in zip(weights, prior, gradients, squares, strict=True):
            g += settings.l2 * (w - p) / base
            s += g * g
            w -= settings.rate * g / np.sqrt(s)
    return Model(index, *weights)


def marginals(model: Model, graph: Graph, settings: Settings) -> np.ndarray:
    """Label probabilities of each token by damped loopy message passing."""
    node = model.potentials(graph)
    held = graph.held >= 0
    node[held] = -60.0
    node[held, graph.held[held]] = 0.0
    edges = np.array([*graph.chain, *graph.skip], int).reshape(-1, 2)
    a, b = edges[:, 0], edges[:, 1]
    pair = np.concatenate([np.broadcast_to(model.chain, (len(graph.chain), LABELS, LABELS)),
                           np.broadcast_to(model.skip, (len(graph.skip), LABELS, LABELS))])
    forth, back = np.zeros((len(edges), LABELS)), np.zeros((len(edges), LABELS))

    def beliefs() -> np.ndarray:
        out = node.copy()
        np.add.at(out, b, forth)
        np.add.at(out, a, back)
        return out

    for _ in range(settings.passes if len(edges) else 0):
        belief = beliefs()
        sent = [np.logaddexp.reduce((belief[a] - back)[:, :, None] + pair, axis=1),
                np.logaddexp.reduce((belief[b] - forth)[:, None, :] + pair, axis=2)]
        forth, back = (settings.damping * old + (1 - settings.damping) * (new - new.max(axis=1, keepdims=True))
                       for old, new in zip((forth, back), sent, strict=True))
    return _softmax(beliefs()) if len(node) else node


def all_spans(text: str, model: Model, settings: Settings) -> list[tuple[int, int, int, bool]]:
    """(kind number, start, end, base) by kind, then start."""
    base = base_spans(text)
    out = [(*s, True) for s in base]
    if len(model.index) and _MAYBE.search(text):
        graph = graph_of(text, base)
        if (graph.held < 0).any():
            chance = marginals(model, graph, settings)
            best = chance.argmax(axis=1)
            taken = (graph.held < 0) & (best != OUTSIDE) & (chance.max(axis=1) >= settings.threshold)
            joined = set(graph.chain)
            added: list[list[int]] = []
            for i in np.flatnonzero(taken).tolist():
                start, end = graph.places[i]
                raw = text[start:end]
                core = raw.strip(_EDGE)
                start += raw.find(core)
                if added and added[-1][3] == i - 1 and (i - 1, i) in joined and added[-1][0] == best[i]:
                    added[-1][2:] = [start + len(core), i]
                else:
                    added.append([int(best[i]), start, start + len(core), i])
            out += [(k, s, e, False) for k, s, e, _ in added if e > s]
    return sorted(out, key=lambda s: (s[0], s[1], s[2]))


# --- Spark ------------------------------------------------------------------------------

def fit(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Train on about ``max_train`` documents that hold candidate tokens; one task, bounded."""
    some = docs.select(text_or_empty("text").alias("text")).filter(F.regexp_like("text", F.lit("[0-9@]")))
    total = some.count()
    if total == 0:
        return Model()
    part = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) / 1_000_000
    schema = pa.schema([("name", pa.string()), ("weights", pa.list_(pa.float64()))])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = sorted({t for batch in batches for t in batch.column("text").to_pylist()})
        model = train([graph_of(t, base_spans(t)) for t in texts], settings)
        names = [None] * len(model.index)
        for name, i in model.index.items():
            names[i] = name
        rows = [*zip(names, model.node.tolist(), strict=True), ("\0chain", model.chain.ravel().tolist()),
                ("\0skip", model.skip.ravel().tolist())]
        yield batch_of({"name": [r[0] for r in rows], "weights": [r[1] for r in rows]}, schema)

    rows = (some.filter(part < F.lit(settings.max_train / total)).repartition(1)
            .mapInArrow(fitted, "name string, weights array<double>").collect())  # the model: some features
    weights = {r["name"]: np.array(r["weights"]) for r in rows}
    if not weights:
        return Model()
    chain, skip = (weights.pop(n).reshape(LABELS, LABELS) for n in ("\0chain", "\0skip"))
    return Model({n: i for i, n in enumerate(weights)}, np.array(list(weights.values())).reshape(-1, LABELS), chain, skip)


_SPANS = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"


def find(docs: DataFrame, model: Model, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """``docs`` with ``spans``: kind, code-point start and end, and whether a base pattern found it."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    @F.arrow_udf(_SPANS)
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = shared.value
        for texts in batches:
            yield pa.array([[{"kind": KINDS[k], "start": a, "end": b, "base": c}
                             for k, a, b, c in all_spans(t.as_py(), fitted, settings)] for t in texts], kind)

    return docs.withColumn("spans", spans.asNondeterministic()(text_or_empty(text)))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
