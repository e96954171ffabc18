"""Suffix arrays of small shards, and the merge of their Burrows-Wheeler
transforms by refining the interleave."""

from __future__ import annotations

import numpy as np

#: Bytes of one symbol; a record's suffixes are merged this many bytes a round.
WORD = 8
#: Suffixes of one shard: ranks fit 16 bits, so every pass over them is a radix pass.
SHARD = 1 << 16


def word_symbols(text: np.ndarray) -> np.ndarray:
    """Per place the number, in sorted order, of the ``WORD`` bytes that start there (zeros follow the text)."""
    padded = np.concatenate([text, np.zeros(WORD, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, WORD)[:len(text) + 1]
    value = np.ascontiguousarray(words).view(">u8").ravel().astype(np.uint64)
    order = np.argsort(value)
    new = np.empty(len(value), bool)
    new[0] = False
    new[1:] = value[order[1:]] != value[order[:-1]]
    number = np.empty(len(value), np.uint32)
    number[order] = np.cumsum(new)
    return number


def shard_suffixes(first: np.ndarray, length: int) -> np.ndarray:
    """The places of one shard in the order of their suffixes, cut at the
    shard's end and compared over ``length`` bytes at least; ``first`` numbers
    the words at its places. Prefix doubling with two radix passes a step."""
    order = np.argsort(first, kind="stable")
    rank = _ranks(order, first[order])
    step = WORD
    while step < length and len(rank) > step:
        ahead = np.zeros(len(rank), np.uint16)
        ahead[:-step] = rank[step:]
        order = np.argsort(ahead, kind="stable")
        order = order[np.argsort(rank[order], kind="stable")]
        rank = _ranks(order, rank[order].astype(np.uint32) << 16 | ahead[order])
        step *= 2
    return order


def _ranks(order: np.ndarray, value: np.ndarray) -> np.ndarray:
    rank = np.empty(len(order), np.uint16)
    new = np.ones(len(order), np.uint16)
    new[0] = 0
    new[1:] = value[1:] != value[:-1]
    rank[order] = np.cumsum(new, dtype=np.uint16)
    return rank


def _sort16(value: np.ndarray) -> np.ndarray:
    """Stable order of numbers below 2^32 by two radix passes."""
    order = np.argsort(value.astype(np.uint16), kind="stable")
    if len(value) and value.max() >> 16:
        order = order[np.argsort((value[order] >> 16).astype(np.uint16), kind="stable")]
    return order


def repeated_strings(records: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(record, start) of every string of ``length`` bytes, a multiple of
    ``WORD``, that starts at two or more places of the records and ends in its
    record.

    The records are laid out in shards. A shard's suffix array gives its
    Burrows-Wheeler transform: per row the word before the suffix, and the row
    of the suffix that starts with that word. The transforms are merged by
    refining the interleave: with rows of all shards in the order of their
    first h bytes, dealing them stably to the words before them gives the
    order by h + WORD bytes, and rows of one word and one former interval form
    an interval with that common prefix. Rows alone in their interval share
    no longer prefix with any other, nor do their predecessors, so they leave.
    After length / WORD rounds the intervals left are the repeated strings; no
    suffix of one shard is ever compared with one of another.
    """
    if length % WORD:
        raise ValueError(f"length must be a multiple of {WORD}")
    sizes = np.array([len(r) for r in records], np.int64)
    text = np.frombuffer(b"".join(records), np.uint8)
    if not len(text):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    symbol_at = word_symbols(text)
    # rows of all shards, shard after shard, and the place of each row; place n ends the last record
    places = np.empty(len(text) + 1, np.int64)
    for a in range(0, len(places), SHARD):
        b = min(a + SHARD, len(places))
        places[a:b] = a + shard_suffixes(symbol_at[a:b], length)
    row_of = np.empty(len(places), np.int32)
    row_of[places] = np.arange(len(places), dtype=np.int32)
    bwt = symbol_at[np.maximum(places - WORD, 0)]
    back = row_of[np.maximum(places - WORD, 0)]
    # the interleave: rows of all shards by their first h bytes. A round goes WORD bytes back, so only
    # places with a whole string before them in their record take part, first as the empty strings there
    own = np.repeat(starts, sizes)
    rows = np.flatnonzero(places - length >= np.concatenate([[len(text)], own])[places]).astype(np.int32)
    interval = np.zeros(len(rows), np.int32)
    for _ in range(0, length, WORD):
        if not len(rows):
            break
        symbol = bwt[rows]
        order = _sort16(symbol)
        symbol, interval, rows = symbol[order], interval[order], back[rows[order]]
        new = np.ones(len(rows) + 1, bool)
        new[1:-1] = (symbol[1:] != symbol[:-1]) | (interval[1:] != interval[:-1])
        shared = ~(new[:-1] & new[1:])
        interval = np.cumsum(new[:-1], dtype=np.int32)[shared]
        rows = rows[shared]
    place = places[rows]
    record = np.searchsorted(ends, place, side="right")
    return record, place - starts[record]
