"""Benchmark decontamination: one automaton over all windows of the test items."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Shared, alnum_words, append_columns, materialise
from .wordscan import PhraseAutomaton, code_points, word_places

FIELDS = ("n_words long, n_hit long, n_items long, items array<string>, items_sha256 string, "
          "contaminated boolean, hit_spans array<struct<start:long,end:long>>")
_BUILT: dict = {}


def item_windows(raw: bytes | None, size: int) -> list[tuple[bytes, ...]]:
    """Every ``size`` consecutive words of an item; all its words if it has fewer, none if it has none."""
    w = alnum_words(raw)
    if len(w) < size:
        return [tuple(w)] if w else []
    return [tuple(w[i:i + size]) for i in range(len(w) - size + 1)]


def _automaton(shard, size: int) -> PhraseAutomaton:
    """Of a shard's windows, each with the ids of its items; kept for the worker's next task."""
    if (shard.id, size) not in _BUILT:
        _BUILT.clear()  # one at a time: memory is that of one shard
        windows: dict[tuple[bytes, ...], set] = {}
        for item, raw in shard.value:
            for w in item_windows(raw, size):
                windows.setdefault(w, set()).add(item)
        _BUILT[shard.id, size] = PhraseAutomaton(windows)
    return _BUILT[shard.id, size]


def _merge(places: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(places):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _scan(raw: list, shards: list, window: int, places: list[list], found: list[set]) -> None:
    """Adds the places (words from, to) and item ids that the shards hit in each text."""
    for shard in shards:
        a = _automaton(shard, window)
        for k, r in enumerate(raw):
            for start, end, ids in a.scan(alnum_words(r)):
                places[k].append((start, end))
                found[k] |= ids


def _fields(raw: list, places: list[list], found: list[set]) -> list[list]:
    out: list[list] = [[] for _ in range(7)]
    for r, p, ids in zip(raw, places, found):
        hit, listed = _merge(p), sorted(i for i in ids if i is not None)
        spans = []
        if hit:
            at = word_places(r)
            flat = code_points(r, [x for a, b in hit for x in (at[a][0], at[b - 1][1])])
            spans = [{"start": s, "end": e} for s, e in zip(flat[::2], flat[1::2])]
        row = (len(alnum_words(r)), sum(b - a for a, b in hit), len(listed), listed,
               hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit), spans)
        for column, v in zip(out, row):
            column.append(v)
    return out


def _passes(sizes: dict[int, int], most: int) -> list[list[int]]:
    """Shards in order, cut to runs of at most ``most`` bytes (one shard at least)."""
    out: list[list[int]] = []
    held = most
    for shard, size in sorted(sizes.items()):
        if held + size > most:
            out.append([])
            held = 0
        out[-1].append(shard)
        held += size
    return out


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                   item_text: str = "text", window: int = 10, shard_bytes: int = 1 << 20,
                   pass_bytes: int = 64 << 20) -> DataFrame:
    """All columns of ``docs`` plus n_words, n_hit, n_items, items, items_sha256,
    contaminated and hit_spans (code points of the original text, end
    exclusive). A column of ``docs`` with one of these names is replaced.

    A word is hit if it lies inside any occurrence of a window of ``window``
    consecutive words of a benchmark item (all words of a shorter item). Each
    text is read once, whole, through one automaton; nothing is shuffled.

    The items go to the workers as a broadcast. Up to ``shard_bytes`` of item
    text make one automaton. A larger benchmark is dealt by a hash of item and
    id to as many shards as needed; a batch of texts then passes the automata
    one after another, so a worker holds one at a time. No broadcast, and
    nothing on the driver, is over ``pass_bytes`` (a single larger item
    apart): beyond it the texts are passed once for every ``pass_bytes`` of
    items, and the hits so far are written to the shared folder in between.

    Null and blank texts have no words. An empty benchmark hits nothing. Items
    with a null id hit words but are not listed; repeated items list once.
    """
    items = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(item_text).cast("binary").alias("t")) \
        .filter("t is not null")
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, -(-total // shard_bytes))
    dealt = items.distinct().withColumn("s", F.pmod(F.xxhash64("t", "i"), F.lit(n)).cast("int"))
    if total <= pass_bytes:
        parts: dict[int, list] = {k: [] for k in range(n)}
        for r in dealt.collect():
            parts[r.s].append((r.i, bytes(r.t)))
        shards = [Shared(docs, part) for part in parts.values()]

        def whole():
            def compute(raw: list) -> list[list]:
                places, found = [[] for _ in raw], [set() for _ in raw]
                _scan(raw, shards, window, places, found)
                return _fields(raw, places, found)
            return compute

        return append_columns(docs, text, FIELDS, whole)

    dealt = materialise(dealt, "items")
    sizes = {r.s: r.n for r in dealt.groupBy("s").agg(F.sum(F.length("t")).alias("n")).collect()}   # a number a shard
    at = max(docs.columns, key=len) + "_at"   # clash with no column
    by = at + "_by"
    state = docs.withColumn(at, F.array().cast("array<struct<start:long,end:long>>")).withColumn(by, F.array().cast("array<string>"))
    for numbers in _passes(sizes, pass_bytes):
        parts = {k: [] for k in numbers}
        for r in dealt.filter(F.col("s").between(numbers[0], numbers[-1])).collect():
            parts[r.s].append((r.i, bytes(r.t)))
        shards = [Shared(docs, part) for part in parts.values()]

        def one_pass(shards=shards):
            def compute(raw: list, before: list, ids: list) -> list[list]:
                places = [[(p["start"], p["end"]) for p in b] for b in before]
                found = [set(i) for i in ids]
                _scan(raw, shards, window, places, found)
                return [[[{"start": a, "end": b} for a, b in _merge(p)] for p in places],
                        [sorted(i for i in f if i is not None) for f in found]]
            return compute

        state = materialise(append_columns(state, text, f"`{at}` array<struct<start:long,end:long>>, `{by}` array<string>",
                                           one_pass, also=(at, by)), "hits")
        for shard in shards:
            shard.drop()

    def last():
        def compute(raw: list, before: list, ids: list) -> list[list]:
            return _fields(raw, [[(p["start"], p["end"]) for p in b] for b in before], [set(i) for i in ids])
        return compute

    return append_columns(state, text, FIELDS, last, also=(at, by)).drop(at, by)
