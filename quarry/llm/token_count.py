"""Token counts of whole texts with overlap resynchronisation."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame

from .common import Shared, append_columns

_LOADED: dict = {}
_BATCH_BYTES = 1 << 20
_WORDS_KEPT = 400_000
_LONGEST_KEPT = 48
_SPACE = " \t\n\r\x0b\x0c"


def _library(definition):
    """The tokenizer, whether it drops white space, and the counts of words seen so far; kept for the worker's next task."""
    if definition.id not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        t = Tokenizer.from_str(definition.value)
        t.no_truncation()
        t.no_padding()
        _LOADED.clear()
        _LOADED[definition.id] = (t, drops_space(t), {})
    return _LOADED[definition.id]


def drops_space(tokenizer) -> bool:
    """Whether no token holds or depends on white space: the pre-tokenizer
    leaves it out between and around words of all kinds, and no added token
    holds or strips it. Only then is a place after white space stable."""
    if tokenizer.pre_tokenizer is None:
        return False
    if any(t.lstrip or t.rstrip or any(c.isspace() for c in t.content) for t in tokenizer.get_added_tokens_decoder().values()):
        return False
    words = ["a", "B", "1", "!", "\u00e9", "\u4e2d", "'s", "x1"]
    probe = "".join(gap + w for c in _SPACE for gap in (c, c + c, c + " ") for w in words) + " "
    if tokenizer.normalizer is not None:
        probe = tokenizer.normalizer.normalize_str(probe)
    if not any(c.isspace() for c in probe):
        return False
    return not any(probe[k].isspace() for _, (i, j) in tokenizer.pre_tokenizer.pre_tokenize_str(probe) for k in range(i, j))


class Chunk:
    """The encoding of text[lo:hi]; ``first`` is the first of its tokens that counts."""

    def __init__(self, tokenizer, text: str, lo: int, hi: int):
        self.encoding = tokenizer.encode(text[lo:hi], add_special_tokens=False)
        self.lo, self.hi, self.first, self.n = lo, hi, 0, len(self.encoding)

    def from_place(self, at: int) -> int:
        """The number of the first token that starts at ``at`` or later."""
        for c in range(max(0, at - self.lo), self.hi - self.lo):
            k = self.encoding.char_to_token(c)
            if k is not None:
                while k < self.n and self.encoding.token_to_chars(k)[0] + self.lo < at:
                    k += 1
                return k
        return self.n

    def tokens(self, i: int, j: int) -> list[tuple[int, int, int]]:
        """(start, end, id) of the tokens i to j - 1, with offsets in the whole text."""
        ids, out = self.encoding.ids, []
        for k in range(i, j):
            a, b = self.encoding.token_to_chars(k)
            out.append((a + self.lo, b + self.lo, ids[k]))
        return out


def stable_boundary(text: str, left: Chunk, right: Chunk, agree: int) -> tuple[int, int] | None:
    """Token numbers in ``left`` and ``right``, of one place in the overlap at
    which the two encodings may be joined.

    The character before it is white space (the tokenizer's pre-tokenizer
    drops white space and no token, merge or composed character spans it, so
    tokens on either side do not depend on the other side), and ``agree``
    tokens on either side are the same in both encodings. The middle one of
    those found, None without any. Only tokens of the overlap are looked at.
    """
    skip = max(left.first, left.from_place(right.lo))
    a = left.tokens(skip, left.n)
    b = {t: k for k, t in enumerate(right.tokens(0, right.from_place(left.hi)))}
    at = [b.get(t, -1) for t in a]
    found = []
    for k in range(agree, len(a) - agree):
        p = a[k][0]
        # the first token of its place: a character may be several tokens
        if p > right.lo and a[k - 1][0] < p and text[p - 1] in _SPACE and at[k] >= agree and \
                all(at[k + d] == at[k] + d for d in range(-agree, agree)):
            found.append((skip + k, at[k]))
    return found[len(found) // 2] if found else None


def resync_count(tokenizer, text: str, chunk: int, overlap: int, agree: int = 4) -> int:
    """Tokens of ``text``, encoded in chunks of ``chunk`` characters that overlap.

    Neighbouring chunks are spliced at a stable boundary of their overlap. If
    there is none the overlap doubles; once it would reach back to the last
    splice, the left chunk itself doubles, so text without any boundary
    is in the end encoded whole.
    """
    n, total, cut = len(text), 0, 0
    left = Chunk(tokenizer, text, 0, min(chunk, n))
    while left.hi < n:
        width = overlap
        while True:
            lo = left.hi - width
            if lo <= cut:
                left = Chunk(tokenizer, text, left.lo, min(n, left.hi + max(chunk, left.hi - left.lo)))
                left.first = left.from_place(cut) if cut else 0
                break
            right = Chunk(tokenizer, text, lo, min(n, lo + max(chunk, 2 * width)))
            joined = stable_boundary(text, left, right, agree)
            if joined is not None:
                total += joined[0] - left.first
                right.first = joined[1]
                left, cut = right, right.tokens(joined[1], joined[1] + 1)[0][0]
                break
            width *= 2
    return total + left.n - left.first


def _count_words(tokenizer, known: dict, texts: list[bytes]) -> list[int]:
    """Tokens of each text, summed over its words between ASCII white space
    (stable boundaries, see above); every new word is encoded once."""
    out, words = [], [t.split() for t in texts]
    once: dict[bytes, int] = {}
    new = {w for text in words for w in text if w not in known}
    order = list(new)
    for lo in range(0, len(order), 4096):
        part = order[lo:lo + 4096]
        for w, e in zip(part, tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in part],
                                                          add_special_tokens=False)):
            once[w] = len(e)
    for text in words:
        out.append(sum([known[w] if w in known else once[w] for w in text]))
    if len(known) + len(once) > _WORDS_KEPT:
        known.clear()
    known.update((w, c) for w, c in list(once.items())[:_WORDS_KEPT] if len(w) <= _LONGEST_KEPT)
    return out


def token_counts(docs: DataFrame, tokenizer_file: str, text: str = "text", limit: int = 2048,
                 chunk: int = 8_192, overlap: int = 256) -> DataFrame:
    """All columns of ``docs`` plus n_bytes (UTF-8), n_tokens and over_limit
    (more than ``limit`` tokens). A column of ``docs`` with one of these names
    is replaced.

    ``tokenizer_file`` is a JSON definition of the ``tokenizers`` library; the
    driver reads it and broadcasts it (a definition over 64 MB is refused).
    Counts are those of the library for the whole text: no begin, end or added
    tokens, special strings in a text as by its default, no truncation. Texts
    over ``chunk`` characters are encoded in overlapping chunks
    (``resync_count``), so memory is bounded by a chunk; shorter ones are
    summed over words between the same kind of boundaries. With a tokenizer
    that keeps white space no boundary is proven stable (``drops_space``), so
    its texts are all encoded whole. Null is empty: 0 bytes, 0 tokens.
    """
    if os.path.getsize(tokenizer_file) > 64 << 20:
        raise ValueError("tokenizer definition over 64 MB")
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = Shared(docs, f.read())

    def make():
        tokenizer, splice, known = _library(definition)

        def count(texts: list[bytes]) -> list[int]:
            if splice:
                return _count_words(tokenizer, known, texts)
            return [len(e) for e in tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts],
                                                                add_special_tokens=False)]

        def compute(raw: list) -> list[list]:
            raw = [r or b"" for r in raw]
            counts, short, size = [0] * len(raw), [], 0
            for k, r in enumerate(raw):
                if splice and len(r) > chunk and len(s := r.decode("utf-8", "replace")) > chunk:
                    counts[k] = resync_count(tokenizer, s, chunk, overlap)
                    continue
                short.append(k)
                size += len(r)
                if size > _BATCH_BYTES:
                    for i, c in zip(short, count([raw[i] for i in short])):
                        counts[i] = c
                    short, size = [], 0
            for i, c in zip(short, count([raw[i] for i in short])):
                counts[i] = c
            return [[len(r) for r in raw], counts, [c > limit for c in counts]]
        return compute

    return append_columns(docs, text, "n_bytes long, n_tokens long, over_limit boolean", make)
