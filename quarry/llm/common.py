"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..sources.files import materialise

__all__ = ["Shared", "append_columns", "byte_words", "alnum_words", "block_rows", "runs", "pairs_in_runs",
           "forest", "hash_sample", "materialise", "code_point_order", "passage"]

_ASCII_TABLE = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32
                     for c in range(256))


class Shared:
    """A broadcast value with a key by which workers know it again."""

    def __init__(self, df: DataFrame, value):
        self.id = uuid.uuid4().hex
        self._held = df.sparkSession.sparkContext.broadcast(value)

    @property
    def value(self):
        return self._held.value

    def drop(self):
        """Frees it, once nothing that reads it can be computed again."""
        self._held.destroy()


def append_columns(df: DataFrame, arg: str, fields: str, make: Callable[[], Callable[..., list[list]]],
                   also: tuple[str, ...] = ()) -> DataFrame:
    """All columns of ``df`` plus ``fields`` (DDL), computed in Arrow batches
    from the string column ``arg``.

    ``make()`` runs once per task and returns a function that maps a list of
    UTF-8 byte strings (None for null) to one list per new field; the values of
    the columns ``also`` follow as further lists. A column of
    ``df`` whose name equals a new field (case does not matter) is replaced.
    Spark bounds a batch by rows and bytes, so memory does not depend on the
    length of the table.
    """
    new = T.StructType.fromDDL(fields)
    taken = {f.name.lower() for f in new}
    keep = [i for i, c in enumerate(df.columns) if c.lower() not in taken]
    at, others = df.columns.index(arg), [df.columns.index(c) for c in also]
    schema = T.StructType([df.schema[i] for i in keep] + list(new))
    names = [f.name for f in schema]
    types = [to_arrow_type(f.dataType) for f in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for b in batches:
            out = compute(b.column(at).cast(pa.binary()).to_pylist(), *[b.column(i).to_pylist() for i in others])
            cols = [b.column(i) for i in keep] + [pa.array(v, type=t) for v, t in zip(out, types)]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return df.mapInArrow(run, schema)


def hash_sample(df: DataFrame, h: str, most: int, by: str | None = None) -> DataFrame:
    """The ``most`` rows with the smallest unsigned hash ``h`` (a long column),
    of each value of ``by`` if given (null left out).

    A count first gives the share of rows that could be among them (three
    times as many on average), and only those leave their task, so neither
    the driver nor a task gets ``most`` rows from every task. Should fewer
    remain than asked for, as with very uneven hashes, the result is smaller;
    a value of ``by`` always keeps the rows of its smallest hash.
    """
    place = F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))
    if by:  # written: the size of the counts is then known, and Spark need not deal the rows by a hot value
        joined = df.join(materialise(df.groupBy(by).agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_least")),
                                     "counts"), by)
    else:
        joined = df.withColumn("_n", F.lit(df.count())).withColumn("_least", F.lit(0.0))
    near = (joined.filter((place * F.col("_n") < F.lit(3.0 * most)) | (place <= F.col("_least"))).drop("_n", "_least")
            .withColumn("_place", place))
    if not by:
        return near.orderBy("_place", *df.columns).limit(most).drop("_place")
    rank = F.row_number().over(Window.partitionBy(by).orderBy("_place", *df.columns))
    return near.withColumn("_rank", rank).filter(F.col("_rank") <= most).drop("_rank", "_place")


def passage(text: Column, h: Column, longest: int, mark: str) -> Column:
    """The text, or of one over ``longest`` characters a passage of that length
    less the words cut at its ends. Its middle is the first character of the
    class ``mark`` after a place given by the hash ``h`` (from the start if
    none comes after it)."""
    n = F.length(text)
    start = F.pmod(h, F.greatest(n, F.lit(1)).cast("long")).cast("int")
    ahead = F.length(F.split(F.substring(text, start + 1, n), mark, 2)[0])
    at = F.when(start + ahead < n, start + ahead).otherwise(F.length(F.split(text, mark, 2)[0]))
    lo = F.greatest(F.lit(0), F.least(at - longest // 2, n - longest))
    cut = F.substring(text, lo + 1, F.lit(longest))
    cut = F.when(lo > 0, F.regexp_replace(cut, r"^\S+\s+(?=\S)", "")).otherwise(cut)
    cut = F.when(lo + longest < n, F.regexp_replace(cut, r"(?<=\S)\s+\S+$", "")).otherwise(cut)
    return F.when(n > longest, cut).otherwise(text)


def byte_words(raw: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) words ``[^\\x20\\x09-\\x0D]+`` of a UTF-8 text."""
    return raw.lower().split() if raw else []


def alnum_words(raw: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) words of letters, digits and any non-ASCII character.
    Bytes from 0x80 only occur inside non-ASCII characters, so working on
    UTF-8 bytes equals working on characters."""
    return raw.translate(_ASCII_TABLE).split() if raw else []


def code_point_order(c: str) -> list[Column]:
    """Ascending by code point, null last (Spark compares UTF-8 bytes, which
    sort like code points)."""
    return [F.col(c).asc_nulls_last()]


def block_rows(df: DataFrame, key: str, uid: str, block: int) -> DataFrame:
    """Deal the rows of each ``key`` to bounded blocks so that every two rows
    of a key meet exactly once.

    A key with n rows is split by a hash of ``uid`` into ceil(n / block)
    blocks; a row goes to one group (key, _a, _b) for each block of its key,
    so a group holds about two blocks at most whatever the size of the key.
    Adds _a <= _b (the pair of blocks) and _blk (the row's own block); rows of
    a group with _a < _b are compared across blocks only. The result is
    partitioned by the group and sorted by it.
    """
    large = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > block)
             .select(key, F.ceil(F.col("_n") / F.lit(block)).cast("int").alias("_nb")))
    large = materialise(large, "large-keys")  # written: its size is then known, and a skewed join can be split
    dealt = (df.join(large, key, "left")
             .withColumn("_nb", F.coalesce("_nb", F.lit(1)))
             .withColumn("_blk", F.pmod(F.xxhash64(uid), F.col("_nb").cast("long")).cast("int"))
             .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1)))
             .withColumn("_a", F.least("_blk", "_o")).withColumn("_b", F.greatest("_blk", "_o"))
             .drop("_o", "_nb"))
    return dealt.repartition(key, "_a", "_b").sortWithinPartitions(key, "_a", "_b")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Cut sorted batches at group borders: yields (table, run) where ``run``
    numbers the groups from 0 and no group is cut."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if rest is None else pa.concat_tables([rest, t])
        if not t.num_rows:
            continue
        run = _run_numbers(t, keys)
        cut = int(np.searchsorted(run, run[-1]))
        rest = t.slice(cut)
        if cut:
            yield t.slice(0, cut).combine_chunks(), run[:cut]
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), _run_numbers(rest, keys)


def _run_numbers(t: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(t.num_rows, dtype=bool)
    for k in keys:
        v = t.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.cumsum(change)


def pairs_in_runs(run: np.ndarray, limit: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index arrays (i, j), i < j, of all pairs inside each run, in slices of
    about ``limit`` pairs: one step compares every row with the row d places on."""
    n = len(run)
    ends = np.searchsorted(run, run, side="right")
    i = np.flatnonzero(ends > np.arange(n) + 1)
    d, got_i, got_j, held = 1, [], [], 0
    while len(i):
        got_i.append(i)
        got_j.append(i + d)
        held += len(i)
        d += 1
        i = i[ends[i] > i + d]
        if held >= limit or not len(i):
            yield np.concatenate(got_i), np.concatenate(got_j)
            got_i, got_j, held = [], [], 0


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components as (u, v): each node but the smallest
    of its component with that smallest node. At most one link a node."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[own], nodes[label[own]]
