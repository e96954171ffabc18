"""Quality classifier: generalised additive model with pairwise interactions."""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, append_columns, hash_sample

FEATURES = ("log_words", "word_length", "upper", "lower", "digits", "symbols", "stops", "non_ascii", "distinct_words",
            "top_word", "repeated_pairs", "line_length", "repeated_lines", "marked_words", "short_words", "capital_words")
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_DIGIT, _STOP = bytes(range(48, 58)), b".,;:?'\"-"
_SYMBOL = bytes(c for c in range(33, 127) if c not in _UPPER + _LOWER + _DIGIT + _STOP)
_HIGH = bytes(range(128, 256))
_ENDS = frozenset(_SYMBOL)


def text_features(raw: bytes | None) -> list[float]:
    """Numbers that describe a whole text; all zero for null and blank."""
    raw = raw or b""
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    share = lambda chars: (size - len(raw.translate(None, chars))) / size
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return [float(np.log1p(n)), sum(map(len, words)) / n, share(_UPPER), share(_LOWER), share(_DIGIT), share(_SYMBOL),
            share(_STOP), share(_HIGH), len(counts) / n, max(counts.values()) / n, 1 - pairs / max(1, n - 1),
            float(np.log1p(size / len(lines))), 1 - len(set(lines)) / len(lines),
            sum([w[-1] in _ENDS for w in words]) / n, sum([len(w) < 4 for w in words]) / n,
            sum([w[0] in _UPPER for w in words]) / n]


class AdditiveModel:
    """Lookup tables: one per feature and one per chosen pair of features."""

    def __init__(self, edges, base, tables, pairs):
        self.edges, self.base, self.tables, self.pairs = edges, base, tables, pairs

    def codes(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        c = self.codes(x)
        s = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            s += t[c[:, j]]
        for a, b, t in self.pairs:
            s += t[c[:, a], c[:, b]]
        return 1 / (1 + np.exp(-s))


def _gain(g, h):
    return g * g / (h + 1.0)


def _cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Best place to cut a row of bins in two: gain and first bin of the right part."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    if not len(gl):
        return 0.0, 0
    gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl) - _gain(g.sum(), h.sum())
    k = int(gain.argmax())
    return float(gain[k]), k + 1


def _leaves(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Newton steps of a shallow tree over the bins of one feature."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = max(((*_cut(g[a:b], h[a:b]), a, b) for a, b in parts), key=lambda x: x[0])
        if best[0] <= 1e-9:
            break
        _, k, a, b = best
        parts.remove((a, b))
        parts += [(a, a + k), (a + k, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + 1.0)
    return out


def _leaves2(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and steps of a tree over a pair: one cut on the first feature, one on the second on either side."""
    best = (0.0, np.zeros(g.shape))
    for k in range(1, g.shape[0]):
        gain, out = -_gain(g.sum(), h.sum()), np.zeros(g.shape)
        for rows in (slice(0, k), slice(k, None)):
            gr, hr = g[rows].sum(0), h[rows].sum(0)
            more, c = _cut(gr, hr)
            gain += _gain(gr.sum(), hr.sum()) + more
            for cols in (slice(0, c), slice(c, None)):
                out[rows, cols] = gr[cols].sum() / (hr[cols].sum() + 1.0)
        if gain > best[0]:
            best = (gain, out)
    return best


def train(x: np.ndarray, y: np.ndarray, rounds: int = 120, rate: float = 0.15, bins: int = 48, leaves: int = 3,
          n_pairs: int = 6, pair_rounds: int = 40) -> AdditiveModel:
    """Cyclic boosting: each round gives every feature in turn a shallow tree
    on the current residuals, added to its table; then the pairs whose trees
    gain most on what is left are boosted the same way. One class only gives
    a constant (its share, smoothed)."""
    edges = [np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1])) if len(col) else np.empty(0) for col in x.T]
    model = AdditiveModel(edges, float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))),
                          [np.zeros(len(e) + 1) for e in edges], [])
    if not len(y) or y.min() == y.max():
        return model
    c = model.codes(x)
    s = np.full(len(y), model.base)
    for _ in range(rounds):
        for j, t in enumerate(model.tables):
            p = 1 / (1 + np.exp(-s))
            step = rate * _leaves(np.bincount(c[:, j], y - p, len(t)), np.bincount(c[:, j], p * (1 - p), len(t)), leaves)
            t += step
            s += step[c[:, j]]

    def grids(a, b):
        shape = (len(model.tables[a]), len(model.tables[b]))
        at = c[:, a] * shape[1] + c[:, b]
        p = 1 / (1 + np.exp(-s))
        return (np.bincount(at, y - p, shape[0] * shape[1]).reshape(shape),
                np.bincount(at, p * (1 - p), shape[0] * shape[1]).reshape(shape))

    d = len(model.tables)
    ranked = sorted(((_leaves2(*grids(a, b))[0], a, b) for a in range(d) for b in range(a + 1, d)), key=lambda v: (-v[0], v[1:]))
    model.pairs = [(a, b, np.zeros((len(model.tables[a]), len(model.tables[b])))) for _, a, b in ranked[:n_pairs]]
    for _ in range(pair_rounds):
        for a, b, t in model.pairs:
            step = rate * _leaves2(*grids(a, b))[1]
            t += step
            s += step[c[:, a], c[:, b]]
    return model


def training_sample(docs: DataFrame, labels: DataFrame, usable, text: str = "text", id_col: str = "doc_id",
                    quality: str = "quality", most: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``most`` labelled documents, chosen by a
    hash of the id; repeated labels of an id count as its largest. The chosen
    ids are at most ``most`` rows, so they are broadcast; the driver gets
    numbers only."""
    chosen = (labels.filter(usable & F.col(quality).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("_id")).agg(F.max(quality).cast("double").alias("_y"))
              .withColumn("_h", F.xxhash64(F.col("_id").cast("string"), F.lit(23))))
    chosen = hash_sample(chosen, "_h", most).select("_id", "_y")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_t")).join(F.broadcast(chosen), "_id")

    def make():
        return lambda raw: [[text_features(r) for r in raw]]

    got = append_columns(rows, "_t", "x array<double>", make).select("_id", "_y", "x").orderBy("_id", "x").toArrow()
    x = np.array(got.column("x").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    return x, np.array(got.column("_y").to_pylist(), dtype=float)


def score_quality(docs: DataFrame, model: AdditiveModel, text: str = "text", at_least: float = 0.3) -> DataFrame:
    """All columns of ``docs`` plus score (0 to 1, higher: good likelier) and
    predicted (1 if score >= ``at_least``). A column of ``docs`` with one of
    these names is replaced. Null and blank texts have all features zero and
    are scored like any other."""
    shared = Shared(docs, model)

    def make():
        m = shared.value

        def compute(raw: list) -> list[list]:
            if not raw:
                return [[], []]
            s = m.score(np.array([text_features(r) for r in raw]))
            return [s.tolist(), (s >= at_least).astype(int).tolist()]
        return compute

    return append_columns(docs, text, "score double, predicted int", make)
