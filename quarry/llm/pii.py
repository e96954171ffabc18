"""Personal data: base patterns and a semi-Markov conditional random field."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, append_columns, hash_sample, passage

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match can only start where a run of digits starts, which the look-behind states to keep long runs linear
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_SECRET = re.compile(r"(?i)\b(?:token|secret|password|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?([A-Za-z0-9_-]{16,})")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = ord(c) - 48
        total += v if k % 2 == 0 else v * 2 - 9 * (v > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start, then kind as listed."""
    out = []
    end = 0
    at = text.find("@")
    while at >= 0:
        lo = at
        while lo > end and text[lo - 1] in _LOCAL:
            lo -= 1
        # the run before this sign is the leftmost place from which a match can use it
        if lo < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((lo, m.end(), 0))
            end = m.end()
            at = text.find("@", end)
        else:
            end = at + 1
            at = text.find("@", at + 1)
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                out.append((*m.span(), 1))
        for m in _CARD.finditer(text):
            d = "".join(_DIGITS.findall(m.group()))
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((*m.span(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGITS.findall(m.group())) <= 15:
                    out.append((*m.span(), 3))
    return [(a, b, KINDS[k]) for a, b, k in sorted(out, key=lambda s: (s[0], s[2], s[1]))]


def seed_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of secrets after a naming word: labels for training only."""
    return [(*m.span(1), "secret") for m in _SECRET.finditer(text)]


_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9\s]|[^\S\n]+")
_SIGNS = re.compile(r"[0-9@]+")
_SPACE = re.compile(r"\s")
_BEFORE = re.compile(r"([A-Za-z]+)[^A-Za-z0-9\n]{0,4}$")
_LONGEST = 24  # tokens in a candidate segment
_MEMORY = 64  # digits and letters of one run that a shape spells out


def islands(text: str) -> list[tuple[int, int]]:
    """Runs of words (white space between by one blank) that hold a digit or
    an at sign: no candidate segment lies outside of them."""
    out: list[tuple[int, int]] = []
    for m in _SIGNS.finditer(text):
        if out and m.start() < out[-1][1]:
            continue
        floor = out[-1][1] if out else 0
        lo = m.start()
        while lo > floor and not text[lo - 1].isspace():
            lo -= 1
        s = _SPACE.search(text, m.end())
        hi = s.start() if s else len(text)
        if out and lo == out[-1][1] + 1 and text[lo - 1] == " ":
            out[-1] = (out[-1][0], hi)
        else:
            out.append((lo, hi))
    return out


def _shape(s: str) -> str:
    s = re.sub(r"[0-9]+", lambda m: f"9{min(len(m.group()), 5)}", s)
    return re.sub(r"[A-Za-z]+", lambda m: "a", s)[:_MEMORY]


def span_features(text: str, a: int, b: int, tokens: int) -> list[str]:
    """Features of the whole segment text[a:b]: what no single token shows."""
    s = text[a:b]
    digits = "".join(_DIGITS.findall(s))
    n = len(digits)
    before = _BEFORE.search(text, max(0, a - 24), a)
    left, right = text[a - 1:a], text[b:b + 1]
    mixed = sum(1 for x, y in zip(s, s[1:]) if x.isdigit() != y.isdigit() and x.isalnum() and y.isalnum())
    groups = s.split(".")
    out = ["*", f"n{min(n, 20)}", f"shape:{_shape(s)}", f"at{s.count('@')}", f"dots{min(s.count('.'), 5)}",
           f"plus{s[0] == '+'}", f"len{min(len(s) // 4, 12)}", f"tok{min(tokens, 12)}", f"blank{min(s.count(' '), 4)}",
           f"ends{s[0].isalnum()}{s[-1].isalnum()}", f"mixed{min(mixed, 8)}",
           "left:" + ("9" if left.isdigit() else "a" if left.isalpha() else left.strip()),
           "right:" + ("9" if right.isdigit() else "a" if right.isalpha() else right.strip()),
           f"cut{left.isalnum()}{right.isalnum()}"]
    if 12 <= n <= 19 and n + s.count(" ") + s.count("-") == len(s):
        out.append(f"luhn{luhn(digits)}")
    if len(groups) == 4 and n + 3 == len(s):
        out.append(f"byte{all(g and len(g) <= 3 and int(g) <= 255 for g in groups)}")
    if before:
        out.append("word:" + before.group(1).lower())
        if len(s) >= 16 and mixed > 2:
            out.append("named:" + before.group(1).lower())
    return out


class Tokens:
    """Tokens of an island, and its candidate segments by first token."""

    def __init__(self, text: str, lo: int, hi: int):
        self.text = text
        flat = np.fromiter((x for m in _TOKEN.finditer(text, lo, hi) for x in m.span()), np.int64)
        self.start, self.end = flat[::2], flat[1::2]
        first = [text[a] for a in self.start.tolist()]
        self.signs = np.concatenate([[0], np.cumsum([c.isdigit() or c == "@" for c in first], dtype=np.int64)])
        self.word = np.array([c.isalnum() for c in first], bool)
        self.opens = self.word | np.array([c in "+(" for c in first], bool)

    def __len__(self) -> int:
        return len(self.start)

    def from_token(self, i: int) -> list[int]:
        """Ends (past the last token) of the segments that start at token ``i``."""
        if not self.opens[i]:
            return []
        return [j for j in range(i + 1, min(len(self), i + _LONGEST) + 1)
                if self.signs[j] > self.signs[i] and self.word[j - 1]]

    def place(self, i: int, j: int) -> tuple[int, int]:
        return int(self.start[i]), int(self.end[j - 1])

    def features(self, i: int, j: int) -> list[str]:
        return span_features(self.text, *self.place(i, j), j - i)


class Island:
    """All candidate segments (first, past the last) of a short island, with their features: for the fit."""

    def __init__(self, text: str, lo: int, hi: int):
        tokens = Tokens(text, lo, hi)
        self.at = list(zip(tokens.start.tolist(), tokens.end.tolist()))
        self.spans = [(i, j) for i in range(len(tokens)) for j in tokens.from_token(i)]
        self.features = [tokens.features(i, j) for i, j in self.spans]


def best_segments(n: int, starting: Callable[[int], tuple[list[int], list[np.ndarray]]],
                  trans: np.ndarray) -> list[tuple[int, int, int]]:
    """Most likely segmentation of ``n`` tokens as (first, past the last, kind):
    dynamic programming over (position, last kind); a position is left by an
    outside token or by a whole entity.

    ``starting(i)`` gives the ends of the segments from ``i`` and their scores
    by kind, and is asked once for each position. Scores are held for the next
    ``_LONGEST`` positions alone; two bytes a token and kind remember the way back.
    """
    k = trans.shape[1]
    ring = _LONGEST + 1
    best = np.full((ring, k + 1), -np.inf)
    best[0, k] = 0.0
    length = np.zeros((n + 1, k + 1), np.int8)   # tokens of the entity that ends here; 0: an outside token
    before = np.full((n + 1, k + 1), k, np.int8)  # the kind before it
    for i in range(n):
        here, after = best[i % ring], best[(i + 1) % ring]
        stay = here > after
        after[stay] = here[stay]
        length[i + 1, stay], before[i + 1, stay] = 0, np.flatnonzero(stay)
        ends, scores = starting(i)
        if ends:
            prior = here[:, None] + trans
            frm, top = prior.argmax(0), prior.max(0)
            for j, score in zip(ends, scores):
                new, old = top + score, best[j % ring]
                better = np.flatnonzero(new > old[:k])
                old[better] = new[better]
                length[j, better], before[j, better] = j - i, frm[better]
        here[:] = -np.inf
    out, at, kind = [], n, int(best[n % ring].argmax())
    while at:
        size, last = int(length[at, kind]), int(before[at, kind])
        if size:
            out.append((at - size, at, kind))
        at, kind = at - (size or 1), last
    return out[::-1]


def _best(n: int, spans, scores: np.ndarray, trans: np.ndarray) -> list[tuple[int, int, int]]:
    """``best_segments`` of segments that are all at hand, in any order."""
    starting: list[list[int]] = [[] for _ in range(n)]
    for x, (i, _) in enumerate(spans):
        starting[i].append(x)
    return best_segments(n, lambda i: ([spans[x][1] for x in starting[i]], [scores[x] for x in starting[i]]), trans)


def _expected(n: int, spans, scores: np.ndarray, trans: np.ndarray):
    """Posterior of every (segment, kind) and expected kind transitions, by
    forward-backward over all segmentations."""
    k = scores.shape[1]
    fwd = np.full((n + 1, k + 1), -np.inf)
    fwd[0, k] = 0.0
    bwd = np.full((n + 1, k + 1), -np.inf)
    bwd[n] = 0.0
    starting: list[list[int]] = [[] for _ in range(n)]
    for x, (i, _) in enumerate(spans):
        starting[i].append(x)
    enter = np.full((n, k), -np.inf)
    for i in range(n):
        fwd[i + 1] = np.logaddexp(fwd[i + 1], fwd[i])
        if starting[i]:
            enter[i] = np.logaddexp.reduce(fwd[i][:, None] + trans, axis=0)
            for x in starting[i]:
                j = spans[x][1]
                fwd[j, :k] = np.logaddexp(fwd[j, :k], enter[i] + scores[x])
    for i in range(n - 1, -1, -1):
        bwd[i] = bwd[i + 1]
        if starting[i]:
            leave = np.logaddexp.reduce(np.array([scores[x] + bwd[spans[x][1], :k] for x in starting[i]]), axis=0)
            bwd[i] = np.logaddexp(bwd[i], np.logaddexp.reduce(trans + leave[None], axis=1))
    z = np.logaddexp.reduce(fwd[n])
    post = np.array([np.exp(enter[i] + scores[x] + bwd[j, :k] - z) for x, (i, j) in enumerate(spans)]).reshape(-1, k)
    turns = np.zeros((k + 1, k))
    for i in range(n):
        if starting[i]:
            leave = np.logaddexp.reduce(np.array([scores[x] + bwd[spans[x][1], :k] for x in starting[i]]), axis=0)
            turns += np.exp(fwd[i][:, None] + trans + leave[None] - z)
    return post, turns


class SpanModel:
    """Weights of whole-span features by kind and transitions between kinds (the last row: none so far)."""

    def __init__(self, number, weights, trans):
        self.number, self.weights, self.trans = number, weights, trans

    def score(self, features: list[str]) -> np.ndarray:
        get = self.number.get
        return self.weights[[i for f in features if (i := get(f)) is not None]].sum(0)

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """Entities of all islands, a start position after the other: neither
        segments nor features of an island are held together."""
        out = []
        for lo, hi in islands(text):
            if hi - lo < 5:  # shorter than any entity
                continue
            tokens = Tokens(text, lo, hi)

            def starting(i: int, tokens: Tokens = tokens) -> tuple[list[int], list[np.ndarray]]:
                ends = tokens.from_token(i)
                return ends, [self.score(tokens.features(i, j)) for j in ends]

            for i, j, c in best_segments(len(tokens), starting, self.trans):
                out.append((*tokens.place(i, j), KINDS[c]))
        return out


def train(texts: list[str], rounds: int = 25, most: int = 500, longest: int = 60, l2: float = 0.5) -> SpanModel | None:
    """Conditional maximum likelihood on islands labelled by the base patterns
    and the secret seeds; up to ``most`` islands of up to ``longest`` tokens
    with an entity and as many without. None if no island has an entity."""
    full, bare = [], []
    for text in texts:
        marked = [*base_spans(text), *seed_spans(text)]
        for lo, hi in islands(text):
            own = [s for s in marked if s[0] < hi and s[1] > lo]
            if len(full if own else bare) >= most or hi - lo < 5 or hi - lo > 8 * longest:
                continue
            island = Island(text, lo, hi)
            if not island.spans or len(island.at) > longest:
                continue
            places = {(island.at[i][0], island.at[j - 1][1]): x for x, (i, j) in enumerate(island.spans)}
            gold, free = [], lo
            for a, b, kind in sorted(own, key=lambda s: (s[0], KINDS.index(s[2]))):
                if a >= free and (a, b) in places:
                    gold.append((places[a, b], KINDS.index(kind)))
                    free = b
            if bool(gold) == bool(own):
                (full if own else bare).append((island, gold))
    if not full:
        return None
    cases, k = full + bare, len(KINDS)
    number: dict[str, int] = {}
    lists = [[number.setdefault(f, len(number)) for f in fs] for c, _ in cases for fs in c.features]
    flat, size = np.concatenate([np.array(x) for x in lists]), np.array([len(x) for x in lists])
    owner, ptr = np.repeat(np.arange(len(lists)), size), np.concatenate([[0], np.cumsum(size)[:-1]])
    first = np.concatenate([[0], np.cumsum([len(c.spans) for c, _ in cases])])
    seen, turns = np.zeros((len(lists), k)), np.zeros((k + 1, k))
    for (_, gold), f in zip(cases, first):
        last = k
        for x, c in gold:
            seen[f + x, c] += 1
            turns[last, c] += 1
            last = c
    params = np.zeros((len(number) + k + 1, k))
    params[number["*"]] = -3.0
    step, old = np.full(params.shape, 0.1), np.zeros(params.shape)
    for _ in range(rounds):
        w, trans = params[:-k - 1], params[-k - 1:]
        scores = np.add.reduceat(w[flat], ptr)
        gap, turned = seen.copy(), turns.copy()
        for (c, _), f in zip(cases, first):
            post, t = _expected(len(c.at), c.spans, scores[f:f + len(c.spans)], trans)
            gap[f:f + len(c.spans)] -= post
            turned -= t
        grad = np.stack([np.bincount(flat, gap[owner, c], len(number)) for c in range(k)], 1)
        grad = np.concatenate([grad, turned]) - l2 * params
        sign = grad * old
        step = np.clip(np.where(sign > 0, step * 1.3, np.where(sign < 0, step * 0.5, step)), 1e-4, 0.5)
        params += np.sign(grad) * step
        old = np.where(sign < 0, 0.0, grad)
    return SpanModel(number, params[:-k - 1], params[-k - 1:])


def training_sample(docs: DataFrame, text: str = "text", most: int = 1_500, longest: int = 8_000) -> list[str]:
    """At most ``most`` texts that hold a digit or an at sign, chosen by a hash
    of the text; of one over ``longest`` characters a passage of that length
    around such a sign: the bound of what the driver gets. Copies of a text
    count once, so a large group of copies can't fill the sample."""
    t = docs.select(F.col(text).alias("t")).filter(F.col("t").rlike("[0-9@]")).withColumn("h", F.xxhash64("t", F.lit(5)))
    marked = t.withColumn("t", passage(F.col("t"), F.col("h"), longest, "[0-9@]"))
    few = marked.join(hash_sample(marked.select("h").distinct(), "h", most), "h").groupBy("h").agg(F.min("t").alias("t"))
    return [r.t for r in few.orderBy("h").collect()]


def all_spans(text: str, model: SpanModel | None) -> tuple[list, list]:
    """Base spans, and base spans with those of the field that overlap none of them."""
    base = base_spans(text)
    if model is None or not _SIGNS.search(text):
        return base, base
    taken = sorted((a, b) for a, b, _ in base)
    out, k = list(base), 0
    ends = np.maximum.accumulate([b for _, b in taken]) if taken else np.empty(0)
    starts = [a for a, _ in taken]
    for a, b, kind in model.spans(text):
        k = int(np.searchsorted(starts, b))
        if not k or ends[k - 1] <= a:
            out.append((a, b, kind))
    return base, sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def joined(spans: list) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def masked(text: str, spans: list) -> str:
    """The text with each span replaced by its kind in brackets; spans that overlap become one, of the first kind."""
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


FIELDS = ("n_email long, n_ip long, n_card long, n_phone long, n_extra long, base_sha256 string, spans string, "
          "masked string")


def personal_data(docs: DataFrame, model: SpanModel | None, text: str = "text", mask: bool = True) -> DataFrame:
    """All columns of ``docs`` plus the counts of base spans by kind, n_extra
    (spans of the field besides), base_sha256, spans (kind:start:end, code
    points, end exclusive) and masked (the text with all spans replaced; null
    unless ``mask``). A column of ``docs`` with one of these names is replaced.

    The field segments the runs of words that hold a digit or an at sign; a
    candidate segment has up to 24 tokens. A run without an end (an inlined
    file of a megabyte) is segmented in a stream: what is held grows by some 50 bytes a
    token, not with its segments. Its spans are added where no base span is. Null is empty: no spans, an empty masked text. Without a model
    only base spans are found.
    """
    shared = Shared(docs, model)

    def make():
        m = shared.value

        def one(raw: bytes | None) -> tuple:
            t = (raw or b"").decode("utf-8", "replace")
            base, full = all_spans(t, m)
            n = [sum(kind == x for _, _, kind in base) for x in BASE]
            return (*n, len(full) - len(base), hashlib.sha256(joined(base).encode()).hexdigest(), joined(full),
                    masked(t, full) if mask else None)

        return lambda raw: [list(c) for c in zip(*map(one, raw))] if raw else [[] for _ in range(8)]

    return append_columns(docs, text, FIELDS, make)
