"""Aho-Corasick automaton over word sequences."""

from __future__ import annotations

import re

import ahocorasick

from .common import _ASCII_TABLE, alnum_words

_RUN = re.compile(rb"[^ ]+")


class PhraseAutomaton:
    """Finds every occurrence of many word sequences in one pass over a text.

    Words are numbered by the phrases' own vocabulary; any other word is 0, on
    which no phrase can go on, so the pass falls back to the root there.
    """

    def __init__(self, phrases: dict[tuple[bytes, ...], object]):
        self._number: dict[bytes, int] = {}
        self._values = list(phrases.values())
        self._size = [len(p) for p in phrases]
        self._found = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for at, p in enumerate(phrases):
            self._found.add_word(tuple(self._number.setdefault(w, len(self._number) + 1) for w in p), at)
        if phrases:
            self._found.make_automaton()

    def scan(self, words: list[bytes]) -> list[tuple[int, int, object]]:
        """(first word, one past the last word, value of the phrase) of every place."""
        if not self._size or not words:
            return []
        get = self._number.get
        numbers = tuple([get(w, 0) for w in words])
        if not any(numbers):
            return []
        return [(end + 1 - self._size[at], end + 1, self._values[at])
                for end, at in self._found.iter(numbers)]


def word_places(raw: bytes) -> list[tuple[int, int]]:
    """Byte offsets (start, end) of ``alnum_words(raw)`` in the original text."""
    return [m.span() for m in _RUN.finditer(raw.translate(_ASCII_TABLE))]


def code_points(raw: bytes, at: list[int]) -> list[int]:
    """Code-point offsets of ascending byte offsets ``at``."""
    out, last, n = [], 0, 0
    for x in at:
        n += len(raw[last:x].decode("utf-8", "replace"))
        last = x
        out.append(n)
    return out


__all__ = ["PhraseAutomaton", "word_places", "code_points", "alnum_words"]
