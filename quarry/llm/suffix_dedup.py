"""Removal of byte strings that occur twice: suffix-array dedup by merging
shard Burrows-Wheeler transforms.

Two equal strings of ``length`` bytes hold the same anchor: the place whose
``anchor`` bytes have the smallest hash, the first one of ties. So every
string is dealt by its anchor, and only strings of one anchor can be equal:

1. Texts get a number and are written once, bucketed by it, packed. Later
   steps join lists of places to them without moving texts again.
2. Each text is cut into records, the strings of one anchor that overlap;
   records of an anchor that occurs once in all texts leave here.
3. Records of one content are counted. Two of them repeat whole.
4. Records that share their anchor with another content meet in a task; their
   shards' transforms are merged by refining the interleave
   (``suffix_merge``), whose last intervals are the repeated strings.
5. An anchor with more than ``limit`` contents, such as a common line in
   different surroundings, is split: each of its strings holds half of the
   missing bytes left or right of the anchor, and these make a longer anchor.
   This goes on for what is still hot; a whole string is one content.
6. The covered ranges go back to the texts.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import scratch_path
from .common import materialise, runs
from .suffix_merge import WORD, repeated_strings

#: Bytes of text that one step of the anchor search holds.
STEP = 1 << 20
#: Bytes of records whose transforms are merged at once, beside those of the last anchor.
MERGED = 300_000
#: Bytes of text in a bucket, and the most buckets that Spark allows.
BUCKET, MOST_BUCKETS = 64 << 20, 100_000

_RANGES = "array<struct<lo:int,hi:int>>"
_ANCHORS = "h long, u long, s int, w int, off int, times int"
_RECORDS = "h long, c long, u long, s int, w int, off int, times int"
_CONTENTS = "h long, c long, n long, w int, off int, data binary"
_PARTS = "ph long, pc long, pn long, lo int, h long, c long, w int, off int, data binary"
_BASE, _BASE_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)


def repeated_passages(docs: DataFrame, text: str = "text", length: int = 200, anchor: int = 48, limit: int = 1024,
                      keep: bool = True) -> DataFrame:
    """The rows of ``docs`` with n_bytes, n_removed, n_spans (long),
    kept_sha256 (hex), spans (the maximal removed runs, bytes from 0, end
    exclusive) and, with ``keep``, kept (the remaining bytes, binary: a run may
    end inside a character).

    Removed is each byte covered by a string of ``length`` UTF-8 bytes that
    starts anywhere else too, in the same text or another; matches never cross
    rows. Null counts as empty; texts shorter than ``length`` stay whole.
    Repeated rows are rows of their own, so their long texts go whole. Ids
    play no part and may be null. An input column that is named like a new one
    is replaced. ``length`` must be a multiple of the merge's word, and longer
    than ``anchor``.

    A task holds one batch of texts, the records of about ``MERGED`` bytes and
    of one anchor (``limit`` contents of less than 2 x ``length`` bytes), and
    the list of one text's ranges, which its length bounds. Contents are told
    apart by two 64-bit hashes. The driver gets one sum of sizes and, per
    split, whether any anchor is hot.
    """
    if length % WORD or not 0 < anchor < length:
        raise ValueError(f"length must be a multiple of {WORD} and above anchor")
    stored, names = _store(docs, text, length)
    found = materialise(stored.select("u", "t").mapInArrow(_anchor_rows(length, anchor), _ANCHORS), "anchors")
    again = found.groupBy("h").agg(F.sum("times").alias("n")).filter("n > 1").select("h")
    places = found.join(again.hint("merge"), "h")
    records = materialise(_at_texts(stored, places, "h", "s", "w", "off", "times").mapInArrow(
        _contents(length), _RECORDS), "records")
    contents = materialise(records.groupBy("h", "c").agg(
        F.sum("times").alias("n"), F.min(F.struct("u", "s")).alias("at"), F.first("w").alias("w"),
        F.first("off").alias("off")), "contents")

    def fetch(rows: DataFrame) -> DataFrame:
        rows = rows.select(F.col("at.u").alias("u"), "h", "c", "n", F.col("at.s").alias("s"), "w", "off")
        return _at_texts(stored, rows, "h", "c", "n", "s", "w", "off").mapInArrow(
            _cut(length), _CONTENTS)

    covered = _covered(contents, fetch, length, anchor, limit)
    own = records.join(covered.hint("merge"), ["h", "c"]).select("u", F.explode("ranges").alias("r"), "s", "w", "times").select(
        "u", (F.col("s") + F.col("r.lo")).alias("lo"), (F.col("s") + F.col("r.hi") + (F.col("times") - 1) * F.col("w")).alias("hi"))
    lists = own.groupBy("u").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    new = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>"
    new = T.StructType.fromDDL(new + ", kept binary" * keep)
    taken = {f.name.lower() for f in new}
    back = {c: f"c{i}" for i, c in enumerate(names) if c.lower() not in taken and c != text}
    rows = stored.join(lists, "u", "left").select("t", "ranges", *back.values())
    out = T.StructType([T.StructField("t", T.BinaryType())] + [rows.schema[c] for c in back.values()] + list(new))
    rows = rows.mapInArrow(_removed(out, keep), out)
    given = [F.col("t").cast("string").alias(text) if c == text else F.col(back[c]).alias(c)
             for c in names if c in back or (c == text and text.lower() not in taken)]
    return rows.select(*given, *[f.name for f in new])


def _store(docs: DataFrame, text: str, length: int) -> tuple[DataFrame, list[str]]:
    """Numbered rows in a bucketed table: u, t (packed text), c0, c1, ... the other columns by place."""
    spark = docs.sparkSession
    names = docs.columns
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET)))
    rows = docs.select(F.monotonically_increasing_id().alias("u"), F.col(f"`{text}`").cast("binary").alias("t"),
                       *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names) if c != text])
    schema = T.StructType(rows.schema.fields)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for b in batches:
            packed = pa.array([None if t is None else press.compress(t) for t in b.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), packed, *b.columns[2:]], names=b.schema.names)

    name = f"texts_{uuid.uuid4().hex[:12]}"
    (rows.mapInArrow(pack, schema).repartition(buckets, "u").write.bucketBy(buckets, "u")
     .option("path", scratch_path(spark, name)).option("compression", "none").saveAsTable(name))
    return spark.table(name), names


def _unpacked(column: pa.Array) -> list[bytes]:
    press = zstandard.ZstdDecompressor()
    return [b"" if t is None else press.decompress(t) for t in column.to_pylist()]


def _at_texts(stored: DataFrame, rows: DataFrame, *fields: str) -> DataFrame:
    """(u, t, items) of the texts that ``rows`` name by u; items are structs of the fields."""
    lists = rows.groupBy("u").agg(F.collect_list(F.struct(*fields)).alias("items"))
    return stored.select("u", "t").join(lists, "u")


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, dict]]:
    """Texts of a batch, their numbers, the text of each item, and the items' fields."""
    for b in batches:
        items = b.column(2)
        flat = items.flatten()
        at = np.repeat(np.arange(b.num_rows), items.value_lengths().to_numpy(zero_copy_only=False))
        yield (_unpacked(b.column(1)), b.column(0).to_numpy(), at,
               {f.name: flat.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(flat.type)})


def _hash8(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(schema))


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


class AnchorSearch:
    """Cuts texts into records, each with the strings of one anchor."""

    def __init__(self, length: int, anchor: int):
        self.length, self.anchor = length, anchor
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _scale(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.powers) < n:
            def series(base: int) -> np.ndarray:
                p = np.full(n, base, np.uint64)
                p[0] = 1
                return np.multiply.accumulate(p)
            self.powers, self.inverses = series(_BASE), series(_BASE_INVERSE)
        return self.powers[:n], self.inverses[:n]

    def records(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """(text, start, strings, anchor's offset, hash, times) per record, its
        strings starting at start, start + 1 and so on. Records of equal
        content in a row, as in a periodic text, are one with ``times``."""
        got, held, size = [], [], 0
        for i, t in enumerate(texts):
            for a in range(0, len(t) - self.length + 1, STEP):
                held.append((i, a, t[a:a + STEP + self.length - 1]))
                size += len(held[-1][2])
                if size >= STEP:
                    got.append(self._step(held))
                    held, size = [], 0
        if held:
            got.append(self._step(held))
        if not got:
            return tuple(np.zeros(0, np.int64) for _ in range(6))
        return tuple(np.concatenate(c) for c in zip(*got))

    def _step(self, held: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
        raw = b"".join(t for _, _, t in held)
        sizes = np.array([len(t) for _, _, t in held])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        width = self.length - self.anchor + 1
        powers, inverses = self._scale(len(raw))
        total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)) * powers, out=total[1:])
        h = (total[self.anchor:] - total[:-self.anchor]) * inverses[:len(raw) - self.anchor + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        # smallest hash of the places in reach of each string's start, the place below it so that the first one wins
        least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        step = 1
        while 2 * step <= width:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if width > step:
            least = np.minimum(least[:step - width], least[width - step:])
        piece = np.repeat(np.arange(len(held)), sizes)[:len(least)]
        first = np.flatnonzero(np.arange(len(least)) + self.length <= ends[piece])
        place = (least[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        piece = piece[first]
        new = np.ones(len(first), bool)
        new[1:] = (place[1:] != place[:-1]) | (piece[1:] != piece[:-1])
        at = np.flatnonzero(new)
        start, place, piece = first[at], place[at], piece[at]
        strings = np.diff(np.append(at, len(first)))
        offset, value = place - start, h[place].view(np.int64)
        as_before = np.zeros(len(at), bool)
        maybe = np.flatnonzero((piece[1:] == piece[:-1]) & (value[1:] == value[:-1]) & (strings[1:] == strings[:-1])
                               & (offset[1:] == offset[:-1])) + 1
        for i, a, w in zip(maybe.tolist(), start[maybe].tolist(), strings[maybe].tolist()):
            as_before[i] = raw[a:a + w + self.length - 1] == raw[a - w:a + self.length - 1]
        own = np.flatnonzero(~as_before)
        times = np.diff(np.append(own, len(at)))
        number = np.array([i for i, _, _ in held])
        base = np.array([a for _, a, _ in held])
        piece = piece[own]
        return (number[piece], start[own] - starts[piece] + base[piece], strings[own], offset[own], value[own], times)


def _anchor_rows(length: int, anchor: int):
    schema = _arrow(_ANCHORS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = AnchorSearch(length, anchor)
        for b in batches:
            number, s, w, off, h, times = search.records(_unpacked(b.column(1)))
            yield _batch(schema, h=h, u=b.column(0).to_numpy()[number], s=s, w=w, off=off, times=times)
    return run


def _contents(length: int):
    schema = _arrow(_RECORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, u, at, x in _items(batches):
            c = [_hash8(texts[i][s:s + w + length - 1]) for i, s, w in zip(at.tolist(), x["s"].tolist(), x["w"].tolist())]
            yield _batch(schema, c=c, u=u[at], **x)
    return run


def _cut(length: int):
    schema = _arrow(_CONTENTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts, _, at, x in _items(batches):
            data = [texts[i][s:s + w + length - 1] for i, s, w in zip(at.tolist(), x["s"].tolist(), x["w"].tolist())]
            yield _batch(schema, data=data, **{k: x[k] for k in ("h", "c", "n", "w", "off")})
    return run


def _covered(contents: DataFrame, fetch, length: int, anchor: int, limit: int) -> DataFrame:
    """(h, c, ranges) of contents with repeated strings; ranges are bytes of
    the content. ``contents`` holds h (the hash of ``anchor`` bytes at ``off``),
    c, n, w (strings) and off; ``fetch`` adds their bytes."""
    hot = F.col("d") > limit
    whole = contents.filter("n > 1").select("h", "c", F.array(F.struct(
        F.lit(0).alias("lo"), (F.col("w") + (length - 1)).alias("hi"))).alias("ranges"))
    meeting = contents.join(contents.groupBy("h").agg(F.count(F.lit(1)).alias("d")).filter("d > 1").hint("merge"), "h")
    groups = fetch(meeting.filter(~hot)).repartition("h").sortWithinPartitions("h")
    out = whole.union(groups.mapInArrow(_merged(length), f"h long, c long, ranges {_RANGES}"))
    if meeting.filter(hot).isEmpty():
        return out
    parts = materialise(fetch(meeting.filter(hot)).mapInArrow(_split(length, anchor), _PARTS), "parts")
    below = materialise(parts.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.first("w").alias("w"),
                                                    F.first("off").alias("off"), F.first("data").alias("data")), "contents")
    found = _covered(below, lambda rows: rows.select("h", "c", "n", "w", "off", "data"), length,
                     anchor + _half(length, anchor), limit)
    moved = parts.filter("pn = 1").drop("w", "off", "data").join(found.hint("merge"), ["h", "c"]).select(
        F.col("ph").alias("h"), F.col("pc").alias("c"),
        F.transform("ranges", lambda r: F.struct((r["lo"] + F.col("lo")).alias("lo"), (r["hi"] + F.col("lo")).alias("hi"))).alias("ranges"))
    return out.union(moved)


def _half(length: int, anchor: int) -> int:
    return -(-(length - anchor) // 2)


def _split(length: int, anchor: int):
    """Per content two parts: strings with at least half of the bytes that the
    anchor lacks before it, and the others. Both have an anchor longer by that half."""
    half, schema = _half(length, anchor), _arrow(_PARTS)

    def parts(w: int, off: int) -> Iterator[tuple[int, int, int, bytes]]:
        left = max(min(w - 1, off - half), -1)
        if left >= 0:
            yield 0, left, off - half, b"l"
        if left + 1 <= w - 1:
            yield left + 1, w - 1, off, b"r"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for h, c, n, w, off, data in zip(*(b.column(b.schema.get_field_index(k)).to_pylist()
                                                  for k in ("h", "c", "n", "w", "off", "data"))):
                for lo, hi, place, side in parts(w, off):
                    piece = data[lo:hi + length]
                    got.append((h, c, n, lo, _hash8(side + data[place:place + anchor + half]), _hash8(piece), hi - lo + 1,
                                place - lo, piece))
            columns = list(zip(*got)) or [()] * 9
            yield _batch(schema, **dict(zip(("ph", "pc", "pn", "lo", "h", "c", "w", "off", "data"), columns)))
    return run


def _merged(length: int):
    """Ranges of contents that occur once, from rows sorted by h."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in runs(batches, ["h"]):
            size = np.cumsum([len(d) for d in table.column("data").to_pylist()])
            a = 0
            while a < table.num_rows:
                b = int(np.searchsorted(size, (size[a - 1] if a else 0) + MERGED))
                b = int(np.searchsorted(group, group[min(b, len(group) - 1)], side="right"))
                yield _ranges(table.slice(a, b - a), length)
                a = b
    return run


def _ranges(table: pa.Table, length: int) -> pa.RecordBatch:
    record, start = repeated_strings(table.column("data").to_pylist(), length)
    once = table.column("n").to_numpy()[record] == 1
    record, start = record[once], start[once]
    order = np.lexsort((start, record))
    record, start = record[order], start[order]
    new = np.ones(len(record), bool)
    new[1:] = (record[1:] != record[:-1]) | (start[1:] > start[:-1] + length)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(record))[:len(first)] - 1
    owner = record[first]
    own = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])[:len(owner)])
    ranges = pa.StructArray.from_arrays([pa.array(start[first], pa.int32()), pa.array(start[last] + length, pa.int32())],
                                        names=["lo", "hi"])
    lists = pa.ListArray.from_arrays(pa.array(np.append(own, len(owner)), pa.int32()), ranges)
    return pa.RecordBatch.from_arrays([pa.array(table.column(k).to_numpy()[owner[own]]) for k in ("h", "c")] + [lists],
                                      names=["h", "c", "ranges"])


def _removed(schema: T.StructType, keep: bool):
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(0)
            texts = _unpacked(raw)
            ranges = b.column(1)
            flat = ranges.flatten()
            lo, hi = (flat.field(i).to_numpy() for i in (0, 1))
            counts = ranges.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(counts)
            n_removed, n_spans, digest, spans, rest = [], [], [], [], []
            for t, a, e in zip(texts, (ends - counts).tolist(), ends.tolist()):
                gone = _union(lo[a:e], hi[a:e]) if e > a else []
                left, at = [], 0
                for x, y in gone:
                    left.append(t[at:x])
                    at = y
                left = b"".join(left) + t[at:] if gone else t
                n_removed.append(len(t) - len(left))
                n_spans.append(len(gone))
                digest.append(hashlib.sha256(left).hexdigest())
                spans.append([{"start": x, "end": y} for x, y in gone])
                rest.append(left)
            whole = pa.array([t if valid else None for t, valid in zip(texts, raw.is_valid().to_pylist())], pa.binary())
            new = {"n_bytes": list(map(len, texts)), "n_removed": n_removed, "n_spans": n_spans, "kept_sha256": digest,
                   "spans": spans} | ({"kept": rest} if keep else {})
            cols = [whole, *b.columns[2:]] + [pa.array(v, type=arrow.field(k).type) for k, v in new.items()]
            yield pa.RecordBatch.from_arrays(cols, names=arrow.names)
    return run


def _union(lo: np.ndarray, hi: np.ndarray) -> list[tuple[int, int]]:
    order = np.argsort(lo)
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    new = np.flatnonzero(np.append(True, lo[1:] > hi[:-1]))
    return list(zip(lo[new].tolist(), hi[np.append(new[1:], len(lo)) - 1].tolist()))
