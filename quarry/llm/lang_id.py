"""Language identification by a linear-chain conditional random field over words."""

from __future__ import annotations

import re

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, append_columns, hash_sample, passage

UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")
_LETTERS = regex.compile(r"\p{L}+")
_STEP = 64
_GROUP = 200_000
_WORDS_KEPT = 300_000


def words_of(text: str) -> list[str]:
    """Runs of letters (\\p{L}), lower-cased."""
    found = _WORD.findall(text.lower())
    if "".join(found).isalpha():
        return found
    # signs such as a half or a raised two count as part of a word above, but are no letters
    return [part for word in found for part in ([word] if word.isalpha() else _LETTERS.findall(word))]


def features(word: str) -> list[str]:
    """Bias, affixes up to three letters, n-grams of two and three letters, the word itself (lexicon)."""
    w = f"<{word}>"
    out = ["*", "=" + word]
    out += ["^" + word[:n] for n in (1, 2, 3)] + ["$" + word[-n:] for n in (1, 2, 3)]
    out += {w[i:i + n] for n in (2, 3) for i in range(len(w) - n + 1)}
    return out


def chain(scores: np.ndarray, starts: np.ndarray, trans: np.ndarray, expected: bool = False):
    """Posterior of the labels of every word by forward-backward.

    ``scores`` (words, K) are the emissions of all texts on end, ``starts``
    the first word of each text (and the end), ``trans`` (K, K) log weights.
    Exact for any length: texts are cut into steps of 64 words, the transfer
    matrices of all steps are multiplied side by side, messages pass from step
    to step, and the words inside all steps are then filled in together.
    Returns the posteriors, with ``expected`` also the expected transitions
    and the log partition sum.
    """
    n, k = scores.shape
    length = np.diff(starts)
    steps = -(-length // _STEP)
    first = np.concatenate([[0], np.cumsum(steps)])
    text = np.repeat(np.arange(len(length)), steps)
    at = starts[:-1][text] + (np.arange(first[-1]) - first[text]) * _STEP
    cells = at[:, None] + np.arange(_STEP)
    real = cells < starts[1:][text][:, None]
    peak = scores.max(1, keepdims=True)
    e = np.exp(scores - peak)
    a = np.exp(trans - trans.max())
    grid = np.where(real[:, :, None], e[np.where(real, cells, 0)], 1.0)
    m = np.broadcast_to(np.eye(k), (len(at), k, k)).copy()
    for t in range(_STEP):
        new = (m @ a) * grid[:, t, None, :]
        new /= new.max(axis=(1, 2), keepdims=True)
        m = np.where(real[:, t, None, None], new, m)
    ahead, behind = np.ones((len(at), k)), np.ones((len(at), k))
    for j in range(1, int(steps.max(initial=0))):
        on = np.flatnonzero(steps > j)
        i = first[on] + j
        f = np.einsum("nk,nkl->nl", ahead[i - 1], m[i - 1])
        ahead[i] = f / f.sum(1, keepdims=True)
        i = first[on + 1] - 1 - j
        b = np.einsum("nkl,nl->nk", m[i + 1], behind[i + 1])
        behind[i] = b / b.sum(1, keepdims=True)
    alpha = np.empty_like(grid)
    f, log_sum = ahead, 0.0
    befores = np.empty_like(grid)
    for t in range(_STEP):
        befores[:, t] = f
        new = (f @ a) * grid[:, t]
        total = new.sum(1, keepdims=True)
        if expected:
            scale = f.sum(1, keepdims=True)
            log_sum += np.log(total / scale)[real[:, t]].sum()
        f = np.where(real[:, t, None], new / total, f)
        alpha[:, t] = f
    b, pairs = behind, np.zeros((k, k))
    post = np.empty_like(scores)
    for t in range(_STEP - 1, -1, -1):
        g = alpha[:, t] * b
        r = real[:, t]
        g /= g.sum(1, keepdims=True)
        post[cells[r, t]] = g[r]
        back = grid[:, t] * b
        if expected:
            x = befores[:, t][r][:, :, None] * a * back[r][:, None, :]
            pairs += (x / x.sum(axis=(1, 2), keepdims=True)).sum(0)
        new = back @ a.T
        b = np.where(r[:, None], new / new.sum(1, keepdims=True), b)
    if expected:
        return post, pairs, log_sum + peak.sum() + n * trans.max()
    return post


class LanguageModel:
    """Feature weights (features, K) and transitions of the field."""

    def __init__(self, labels, number, weights, trans):
        self.labels, self.number, self.weights, self.trans = labels, number, weights, trans

    def emission(self, word: str) -> np.ndarray:
        get = self.number.get
        at = [i for f in features(word) if (i := get(f)) is not None]
        return self.weights[at].sum(0)


def _switched(texts: list[list[str]], gold: np.ndarray, rng) -> tuple[list[list[str]], list[np.ndarray]]:
    """The texts and, for every second one, a text spliced with pieces of another one: code-switched examples."""
    words, labels = [], []
    for i, t in enumerate(texts):
        words.append(t)
        labels.append(np.full(len(t), gold[i]))
        if i % 2:
            j = int(rng.integers(len(texts)))
            a, b = int(rng.integers(10, 60)), int(rng.integers(10, 60))
            mixed = [*t[:a], *texts[j][:b], *t[a:a + 40]]
            words.append(mixed)
            labels.append(np.concatenate([np.full(len(t[:a]), gold[i]), np.full(len(texts[j][:b]), gold[j]),
                                          np.full(len(t[a:a + 40]), gold[i])]))
    return words, labels


def train(samples: list[tuple[str, str]], rounds: int = 30, l2: float = 1.0, seed: int = 3) -> LanguageModel | None:
    """Maximum likelihood with an L2 penalty on labelled texts (text, lang);
    None if no sample has a word. Resilient full-batch steps, so no rate is tuned."""
    samples = [(w, lang) for text, lang in samples if (w := words_of(text))]
    if not samples:
        return None
    labels = sorted({lang for _, lang in samples})
    k = len(labels)
    gold = np.array([labels.index(lang) for _, lang in samples])
    texts, marks = _switched([w for w, _ in samples], gold, np.random.default_rng(seed))
    keep = [i for i, t in enumerate(texts) if t]
    texts, marks = [texts[i] for i in keep], np.concatenate([marks[i] for i in keep])
    types: dict[str, int] = {}
    tokens = np.array([types.setdefault(w, len(types)) for t in texts for w in t])
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    number: dict[str, int] = {}
    lists = [[number.setdefault(f, len(number)) for f in features(w)] for w in types]
    size = np.array([len(x) for x in lists])
    flat, owner = np.concatenate([np.array(x) for x in lists]), np.repeat(np.arange(len(types)), size)
    ptr = np.concatenate([[0], np.cumsum(size)[:-1]])
    seen = np.zeros((len(types), k))
    np.add.at(seen, (tokens, marks), 1.0)
    inner = np.ones(len(tokens), bool)
    inner[starts[:-1]] = False
    turns = np.zeros((k, k))
    np.add.at(turns, (marks[np.flatnonzero(inner) - 1], marks[inner]), 1.0)
    params = np.zeros((len(number) + k, k))
    step, last = np.full(params.shape, 0.05), np.zeros(params.shape)
    for _ in range(rounds):
        w, trans = params[:-k], params[-k:]
        emission = np.add.reduceat(w[flat], ptr)
        post, pairs, _ = chain(emission[tokens], starts, trans, expected=True)
        gap = seen.copy()
        for c in range(k):
            gap[:, c] -= np.bincount(tokens, weights=post[:, c], minlength=len(types))
        grad = np.empty_like(params)
        for c in range(k):
            grad[:-k, c] = np.bincount(flat, weights=gap[owner, c], minlength=len(number))
        grad[-k:] = turns - pairs
        grad -= l2 * params
        sign = grad * last
        step = np.clip(np.where(sign > 0, step * 1.3, np.where(sign < 0, step * 0.5, step)), 1e-4, 0.5)
        params += np.sign(grad) * step
        last = np.where(sign < 0, 0.0, grad)
    return LanguageModel(labels, number, params[:-k], params[-k:])


def training_sample(docs: DataFrame, usable, text: str = "text", lang: str = "lang", id_col: str = "doc_id",
                    per_label: int = 80, most: int = 1600, longest: int = 6_000) -> list[tuple[str, str]]:
    """At most ``per_label`` labelled texts a label and ``most`` in all, shared
    evenly, but one at least of each label, chosen by a hash of the id. Of a
    text over ``longest`` characters a passage of that length is taken: the
    bound of what the driver gets. Texts without a letter are left out."""
    rows = docs.select(F.col(text).alias("t"), F.col(lang).cast("string").alias("l"),
                       F.xxhash64(F.col(id_col).cast("string"), F.lit(17)).alias("h"), usable.alias("ok")).filter(
        F.col("ok") & F.col("l").isNotNull() & F.col("t").rlike(r"\p{L}"))
    labels = rows.agg(F.count_distinct("l")).first()[0]
    share = max(1, min(per_label, most // max(1, labels)))
    few = hash_sample(rows.select(passage(F.col("t"), F.col("h"), longest, r"\p{L}").alias("t"), "l", "h"), "h", share, "l")
    return [(r.t, r.l) for r in few.orderBy("h", "l", "t").collect()]


_WORKER: dict = {}


def predict(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus lang_pred and score. A column of ``docs``
    with one of these names is replaced.

    Every word of the whole text gets a posterior over the languages;
    ``lang_pred`` is the language with the largest sum (the first in order of
    name on a tie) and ``score`` its share. ``und`` with score 0 if the text
    is null, has no letter, or nothing was learned. Texts are worked on in
    groups of about 200,000 words, so memory is bounded by the longest text.
    """
    shared = Shared(docs, model)

    def make():
        if _WORKER.get("id") != shared.id:
            _WORKER.update(id=shared.id, model=shared.value, known={}, table=None)
        m = _WORKER["model"]

        def group(texts: list[list[str]]) -> list[tuple[str, float]]:
            known = _WORKER["known"]
            if len(known) > _WORDS_KEPT:
                known.clear()
                _WORKER["table"] = None
            at, fresh = [], []
            for t in texts:
                for w in t:
                    i = known.get(w)
                    if i is None:
                        i = known[w] = len(known)
                        fresh.append(m.emission(w))
                    at.append(i)
            if fresh:
                old = [] if _WORKER["table"] is None else [_WORKER["table"]]
                _WORKER["table"] = np.concatenate([*old, np.array(fresh)])
            starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            post = chain(_WORKER["table"][np.array(at)], starts, m.trans)
            mass = np.add.reduceat(post, starts[:-1]) / np.diff(starts)[:, None]
            best = mass.argmax(1)
            return [(m.labels[b], min(1.0, float(x[b]))) for b, x in zip(best, mass)]

        def compute(raw: list) -> list[list]:
            langs, scores = [UNKNOWN] * len(raw), [0.0] * len(raw)
            if m is None:
                return [langs, scores]
            held, texts, size = [], [], 0
            for k, r in enumerate(raw):
                if r and (w := words_of(r.decode("utf-8", "replace"))):
                    held.append(k)
                    texts.append(w)
                    size += len(w)
                if held and (size > _GROUP or k == len(raw) - 1):
                    for i, (lang, score) in zip(held, group(texts)):
                        langs[i], scores[i] = lang, score
                    held, texts, size = [], [], 0
            return [langs, scores]
        return compute

    return append_columns(docs, text, "lang_pred string, score double", make)
