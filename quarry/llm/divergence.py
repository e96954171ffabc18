"""How far the word use of sources lies apart: sums over all terms for every
pair of groups by Gustavson row accumulation."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

#: Postings of one index block, and rows that one task accumulates.
BLOCK, ROWS = 200_000, 256
#: Entries of the counting table that a task holds before it hands them on.
HELD = 400_000

_LETTERS = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def terms(raw: bytes | None) -> list[bytes]:
    """Runs of letters and non-ASCII characters, A-Z lower-cased."""
    return raw.translate(_LETTERS).split() if raw else []


def term_counts(docs: DataFrame, within: str, group: str, text: str, held_entries: int = HELD) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term.
    Tasks count first, so a hot group is some rows per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def rows() -> pa.RecordBatch:
            cols = [[], [], [], [], []]
            for (lang, source), (n, d) in held.items():
                cols[0] += [lang] * len(n)
                cols[1] += [source] * len(n)
                cols[2] += n.keys()
                cols[3] += n.values()
                cols[4] += [d[t] for t in n]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.binary()).view(pa.string()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())], names=["lang", "source", "term", "n", "docs"])

        for b in batches:
            for lang, source, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                n, d = held.setdefault((lang, source), (Counter(), Counter()))
                found = terms(raw)
                n.update(found)
                d.update(set(found))
            if sum(len(n) for n, _ in held.values()) > held_entries:
                yield rows()
        yield rows()

    rows = docs.select(_named(within).alias("lang"), _named(group).alias("source"), F.col(f"`{text}`").cast("binary"))
    counted = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _named(c: str) -> Column:
    return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))


def source_divergence(docs: DataFrame, text: str = "text", within: str = "lang", group: str = "source",
                      min_docs: int = 30, smoothing: int = 5, scale: int = 1_000_000_000, top: int = 50,
                      block: int = BLOCK, band: int = ROWS, held: int = HELD) -> DataFrame:
    """(lang, source, part, item, value, rank) per (lang, source) group.

    Terms are those in at least ``min_docs`` documents of the lang (V of them).
    A group gives each the integer p = 1 + floor(scale * (count + smoothing) /
    (N + smoothing * V)), N its occurrences of all of them. Part ``pair``: every
    other source of the lang by the sum of |p - q| over all V terms. Part
    ``term``: terms that occur in the group more than in the lang as a whole
    (p > q), by p - q, up to rank ``top``. Ranks go by value descending, then item by
    code point. Null text, lang and source count as empty strings. A group
    without terms has pairs, and a lang without terms (V = 0) has pairs of
    value 0; a group alone in its lang has none. An empty table gives no rows.
    Repeated rows count as often as they occur; other columns play no part.

    Counts are aggregated in tasks first. The index of a lang is dealt by term
    to blocks of about ``block`` postings; a task holds one block and the
    accumulators of ``band`` groups. A counting task holds about ``held``
    entries and the terms of one batch. The driver gets nothing. Windows run over
    the sources of a lang, or keep ``top`` rows of a group.
    """
    counted = materialise(term_counts(docs, within, group, text, held), "term-counts")
    kept = (counted.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
            .filter(F.col("docs") >= min_docs).select("lang", "term", "lang_n"))
    kept = materialise(kept, "kept-terms")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum(F.col("lang_n").cast("decimal(38,0)")).alias("lang_total"))
    used = materialise(counted.join(kept, ["lang", "term"]).drop("docs"), "used-terms")
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("own"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = (docs.select(_named(within).alias("lang"), _named(group).alias("source")).distinct()
              .join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", number.alias("g"), F.coalesce("v", F.lit(0)).alias("v"), "lang_total",
                      F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("own", F.lit(0)).alias("own")))
    groups = materialise(groups, "groups")

    def p(count: str, total: str) -> Column:
        return F.expr(f"1 + cast({scale} as decimal(10,0)) * (cast({count} as decimal(24,0)) + {smoothing})"
                      f" div (cast({total} as decimal(30,0)) + cast({smoothing} as decimal(5,0)) * cast(v as decimal(20,0)))")

    rows = used.join(groups, ["lang", "source"]).select("lang", "source", "g", "term", p("n", "total").alias("p"),
                                                        p("lang_n", "lang_total").alias("q"))
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.col("item"))
    raised = rows.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         (F.col("p") - F.col("q")).alias("value"))
    raised = raised.withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)
    return _pairs(groups, rows, p, block, band).withColumn("rank", F.row_number().over(by_value)).unionByName(raised)


def _pairs(groups: DataFrame, rows: DataFrame, p, block: int, band: int) -> DataFrame:
    """(lang, source, part, item, value) of every two groups of a lang."""
    zero = F.when(F.col("v") > 0, p("0", "total")).otherwise(F.lit(0))
    sizes = (groups.groupBy("lang").agg(
        F.greatest(F.lit(1), F.ceil(F.sum("own") / block)).cast("int").alias("blocks"),
        F.ceil(F.count(F.lit(1)) / band).cast("int").alias("bands"), F.max("v").alias("v"),
        F.transform(F.array_sort(F.collect_list(F.struct("g", zero.alias("z")))), lambda s: s["z"]).alias("zeros")))
    sizes = materialise(sizes, "index-sizes")
    bands = F.explode(F.sequence(F.lit(0), F.col("bands") - 1)).alias("band")
    tasks = (sizes.select("lang", "v", "zeros", "blocks", bands)
             .select("lang", "v", "zeros", "band", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")))
    index = (rows.join(sizes.select("lang", "blocks", "bands"), "lang")
             .select("lang", F.pmod(F.xxhash64("term"), F.col("blocks").cast("long")).cast("int").alias("block"), bands, "term", "g", "p"))
    keys = ["lang", "block", "band"]
    sums = (index.groupBy(*keys).cogroup(tasks.groupBy(*keys))
            .applyInPandas(_accumulate(band), "lang string, g int, sums array<long>")
            .select("lang", "g", F.posexplode("sums").alias("peer", "value"))
            .groupBy("lang", "g", "peer").agg(F.sum("value").alias("value")).filter("g <> peer"))
    return (sums.join(groups.select("lang", "g", "source"), ["lang", "g"])
            .join(groups.select("lang", F.col("g").alias("peer"), F.col("source").alias("item")), ["lang", "peer"])
            .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))


def _accumulate(rows: int):
    """Of one block of terms, the sums of each row of one band over all peers.

    With z the p of a count of zero, a term adds |z_i - z_j| if neither group
    has it, |p_i - z_j| or |z_i - p_j| if one has it. Those baselines come for
    all peers at once, from sorted values and their running sums. Then each
    row scatters its terms: for every posting of a term it adds, to the peer's
    place, what |p_i - p_j| is more than the baselines.
    """
    def run(index: pd.DataFrame, task: pd.DataFrame) -> pd.DataFrame:
        lang, v, block, band = (task[c].iloc[0] for c in ("lang", "v", "block", "band"))
        z = np.asarray(task["zeros"].iloc[0], np.int64)
        first, last = int(band) * rows, min((int(band) + 1) * rows, len(z))
        code, _ = pd.factorize(index["term"])
        g, value = index["g"].to_numpy(np.int64), index["p"].to_numpy(np.int64)
        by_term = np.argsort(code, kind="stable")  # term-major: the postings of a term lie together
        peer, held = g[by_term], value[by_term]
        ends = np.cumsum(np.bincount(code, minlength=1))
        by_row = np.lexsort((value, g))
        row_at = np.searchsorted(g[by_row], np.arange(len(z) + 1))
        apart = np.abs(z[first:last, None] - z[None, :])
        own, other = np.empty_like(apart), np.empty_like(apart)
        for r in range(len(z)):  # sums of |p - z_j| - |z_r - z_j| over the terms of row r
            mine = value[by_row[row_at[r]:row_at[r + 1]]]
            if first <= r < last:
                own[r - first] = _distances(mine, z) - len(mine) * apart[r - first]
            other[:, r] = _distances(mine, z[first:last]) - len(mine) * apart[:, r]
        sums = own + other + (apart * int(v) if block == 0 else 0)
        for r in range(first, last):
            mine = by_row[row_at[r]:row_at[r + 1]]
            n = np.diff(np.append(0, ends))[code[mine]]
            posting = np.repeat(ends[code[mine]] - np.cumsum(n), n) + np.arange(n.sum())
            j, q, x = peer[posting], held[posting], np.repeat(value[mine], n)
            np.add.at(sums[r - first], j, np.abs(x - q) - np.abs(x - z[j]) - np.abs(q - z[r]) + np.abs(z[r] - z[j]))
        return pd.DataFrame({"lang": lang, "g": np.arange(first, last), "sums": list(sums)})
    return run


def _distances(ordered: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Per point the sum of distances to all the ordered values."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(ordered)])
    below = np.searchsorted(ordered, points)
    return points * (2 * below - len(ordered)) + total[-1] - 2 * total[below]
