"""Licence scan: identifier tags and notice phrases, licence expressions."""

from __future__ import annotations

import re
from bisect import bisect_left

from pyspark.sql import DataFrame

from .common import alnum_words, append_columns
from .wordscan import PhraseAutomaton, code_points, word_places

# Phrases of the base labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notice phrases and their labels; the longest phrase at a place decides.
NOTICES = {
    "apache license": "apache", "apache license version 2 0": "apache-2.0",
    "mit license": "mit", "permission is hereby granted free of charge to any person": "mit",
    "bsd license": "bsd", "redistribution and use in source and binary forms": "bsd",
    "gnu general public license": "gpl", "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl",
    "mozilla public license": "mpl", "mozilla public license version 2 0": "mpl-2.0",
    "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd", "cc0": "cc0", "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc", "public domain": "public-domain",
    "no part of this publication may be reproduced": "reserved",
}
TAG = "spdx license identifier"

# How far a licence restricts reuse, by the start of its label (the longest that fits).
RESTRICTION = {
    "": 0.5, "public-domain": 0.05, "cc0": 0.05, "mit": 0.1, "bsd": 0.1, "isc": 0.1, "apache": 0.15, "zlib": 0.1,
    "unlicense": 0.05, "cc-by": 0.2, "cc-by-sa": 0.5, "cc-by-nd": 0.8, "cc-by-nc": 0.8, "mpl": 0.4, "lgpl": 0.5,
    "epl": 0.4, "gpl": 0.6, "agpl": 0.7, "reserved": 1.0,
}
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_LEAD, _BLANKS, _EOL = re.compile(r"[ \t:]*"), re.compile(r"[ \t]*"), re.compile(r"[\r\n]")
_RANK = {"OR": 1, "AND": 2, "WITH": 3}
FIELDS = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, expressions array<string>, spans array<struct<start:long,end:long,label:string>>")


def restriction(label: str) -> float:
    return RESTRICTION[max((k for k in RESTRICTION if label.startswith(k)), key=len)]


def parse_expression(text: str, start: int = 0, stop: int | None = None) -> tuple[set[str], float, int] | None:
    """Labels, restriction and end of the longest licence expression at ``start`` of ``text``, up to ``stop``.

    A shunting-yard pass: WITH binds closest, then AND, then OR. A choice (OR)
    restricts as its mildest part, a conjunction (AND) as its strictest, and
    an exception (WITH) eases its licence by 0.1 and is no label. Tokens are
    read while they can continue the expression; operators and parentheses
    left open at the end are cut off. None if no expression starts here.
    """
    tokens, want, depth, good = [], True, 0, (0, 0)
    stop = len(text) if stop is None else stop
    at = _LEAD.match(text, start, stop).end()
    while m := _TOKEN.match(text, at, stop):
        t = m.group()
        op = t.upper() in _RANK
        if t == "(" and want:
            depth += 1
        elif t == ")" and not want and depth:
            depth -= 1
        elif t not in "()" and op != want:
            want = op
        else:
            break
        tokens.append(t)
        at = m.end()
        if not want and not depth:
            good = (len(tokens), at)
        at = _BLANKS.match(text, at, stop).end()
    if not good[0]:
        return None
    values: list[tuple[set[str], float]] = []
    ops: list[str] = []

    def reduce():
        op = ops.pop()
        (b, y), (a, x) = values.pop(), values.pop()
        if op == "WITH":
            values.append((a, max(0.0, x - 0.1)))
        else:
            values.append((a | b, min(x, y) if op == "OR" else max(x, y)))

    for t in tokens[:good[0]]:
        if t == "(":
            ops.append(t)
        elif t == ")":
            while ops[-1] != "(":
                reduce()
            ops.pop()
        elif t.upper() in _RANK:
            while ops and ops[-1] != "(" and _RANK[ops[-1]] >= _RANK[t.upper()]:
                reduce()
            ops.append(t.upper())
        else:
            label = t.lower()
            values.append(({label}, restriction(label)))
    while ops:
        reduce()
    return values[0][0], values[0][1], good[1]


def _longest(notices: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Of notices that overlap the longest, then the first: taken in that order
    where none taken before lies. The taken ones never overlap, so only the
    neighbours in order of start can meet a new one."""
    starts: list[int] = []
    taken: dict[int, tuple[int, int, str]] = {}
    for s, e, v in sorted(notices, key=lambda x: (x[0] - x[1], x[0])):
        at = bisect_left(starts, s)
        if (not at or taken[starts[at - 1]][1] <= s) and (at == len(starts) or starts[at] >= e):
            starts.insert(at, s)
            taken[s] = (s, e, v)
    return sorted(taken.values(), key=lambda x: (x[0] - x[1], x[0]))


def licences(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` plus n_words, n_base, first_word, last_word,
    base_labels, labels, score, expressions and spans (code points, end
    exclusive, with the label found there). A column of ``docs`` with one of
    these names is replaced.

    One automaton finds the base phrases, the notice phrases and the
    identifier tag; the expression after a tag, to the end of its line, is
    parsed and evaluated. Base places are all places of a base phrase. Of
    notices that overlap the longest counts. ``score`` is how far the text's
    notices restrict reuse: the strictest of them, 0 without any. Null and
    blank texts have no words, no labels (empty strings) and score 0.
    """
    def make():
        phrases: dict = {}
        for p, label in BASE_PHRASES.items():
            phrases.setdefault(tuple(p.encode().split()), {})["base"] = label
        for p, label in NOTICES.items():
            phrases.setdefault(tuple(p.encode().split()), {})["notice"] = label
        phrases.setdefault(tuple(TAG.encode().split()), {})["tag"] = True
        a = PhraseAutomaton(phrases)

        def one(raw: bytes | None) -> tuple:
            words = alnum_words(raw)
            places = a.scan(words)
            if not places:
                return len(words), 0, None, None, "", "", 0.0, [], []
            offsets = word_places(raw)
            base = [(s, e, v["base"]) for s, e, v in places if "base" in v]
            labels, score, expressions = {v for _, _, v in base}, 0.0, []
            spans = [(s, e, v) for s, e, v in base]
            kept = _longest([(s, e, v["notice"]) for s, e, v in places if "notice" in v])
            labels |= {v for _, _, v in kept}
            spans += kept
            covered = {i for s, e, _ in kept for i in range(s, e)}
            score = max([0.0, *(restriction(v) for _, _, v in kept),
                         *(restriction(v) for s, e, v in base if not covered >= set(range(s, e)))])
            found = [(offsets[s][0], offsets[e - 1][1], v) for s, e, v in spans]
            tags = [(offsets[s][0], offsets[e - 1][1]) for s, e, v in places if "tag" in v]
            edges = sorted({x for s, e, *_ in found + tags for x in (s, e)})
            point = dict(zip(edges, code_points(raw, edges)))
            found = [(point[s], point[e], v) for s, e, v in found]
            whole = raw.decode("utf-8", "replace") if tags else ""
            stop = -1
            for s, e in sorted(tags):
                if stop < point[e]:
                    eol = _EOL.search(whole, point[e])
                    stop = eol.start() if eol else len(whole)
                if got := parse_expression(whole, point[e], stop):
                    labels |= got[0]
                    score = max(score, got[1])
                    expressions.append(whole[point[e]:got[2]].strip(" \t:"))
                    found.append((point[s], got[2], expressions[-1]))
            return (len(words), len(base), min((s for s, _, _ in base), default=None),
                    max((s for s, _, _ in base), default=None), ",".join(sorted({v for _, _, v in base})),
                    ",".join(sorted(labels)), score, expressions,
                    [{"start": a, "end": b, "label": v} for a, b, v in sorted(found)])

        return lambda raw: [list(c) for c in zip(*map(one, raw))] if raw else [[] for _ in range(9)]

    return append_columns(docs, text, FIELDS, make)
