"""Near-duplicates by SimHash: segment popcounts, grid join, exact check."""

from __future__ import annotations

from itertools import combinations_with_replacement, product, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import append_columns, block_rows, byte_words, forest, materialise, pairs_in_runs, runs
from .components import connected_components

SEED = 42
_CHUNK = 1 << 15


def fingerprint(words: list[bytes], shingle: int) -> int:
    """64-bit SimHash (as a signed long) of the word shingles, repeats
    included: a bit is 1 if set in over half the shingle hashes. A sequence
    shorter than ``shingle`` is one shingle; no words give zero. Long texts
    are hashed in slices, so memory stays bounded."""
    n = len(words) - shingle + 1
    if not words:
        return 0
    if n < 1:
        n, shingle = 1, len(words)
    ones = np.zeros(64, dtype=np.int64)
    for lo in range(0, n, _CHUNK):
        part = words[lo:min(lo + _CHUNK, n) + shingle - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(shingle))))
        h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, out: str = "fp") -> DataFrame:
    """All columns of ``docs`` plus the signed 64-bit fingerprint ``out``."""
    def make():
        return lambda raw: [[fingerprint(byte_words(r), shingle) for r in raw]]
    return append_columns(docs, text, f"{out} long", make)


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _steps(segments: int, radius: int, base: int) -> list[int]:
    """Packed offsets of the lattice points within Manhattan ``radius``."""
    found = {0}
    for r in range(1, radius + 1):
        for dims in combinations_with_replacement(range(segments), r):
            for signs in product((1, -1), repeat=r):
                found.add(sum(s * base ** d for s, d in zip(signs, dims)))
    return sorted(found)


def _cell(fp: Column, segments: int, radius: int, base: int) -> Column:
    """Bit counts of the segments as one number, a digit each; digits start at
    ``radius``, so steps never borrow from the next one."""
    width = 64 // segments
    cell = F.lit(0).cast("long")
    for i in range(segments):
        bits = F.shiftrightunsigned(fp, width * i).bitwiseAND(F.lit((1 << width) - 1))
        cell = cell + (F.bit_count(bits) + radius).cast("long") * F.lit(base ** i).cast("long")
    return cell


def linked_fingerprints(fps: DataFrame, max_bits: int, segments: int = 16, block: int = 512) -> DataFrame:
    """Links (a, b) between representatives of fingerprints that differ in at
    most ``max_bits`` bits; ``fps`` has distinct ``fp`` with ``rep``.

    A flipped bit moves one segment count by one, so the Manhattan distance of
    the count vectors never exceeds the bit distance. Two lattice points
    within distance d have a common point within ceil(d / 2) of each, so
    entering every fingerprint in the cells of that radius makes each true
    pair meet; pairs that meet are then compared bit by bit. Cells with many
    fingerprints are dealt to bounded blocks, and a block sends back a
    spanning forest of its links, not the links.
    """
    if max_bits < 0 or max_bits > 6:
        raise ValueError("max_bits must lie between 0 and 6")
    radius = (max_bits + 1) // 2
    base = 64 // segments + 2 * radius + 1
    near = F.array(*[F.lit(s).cast("long") for s in _steps(segments, radius, base)])
    cells = (fps.withColumn("_c", _cell(F.col("fp"), segments, radius, base))
             .select("fp", "rep", F.explode(F.transform(near, lambda s: F.col("_c") + s)).alias("cell")))

    def compare(batches):
        for t, run in runs(batches, ["cell", "_a", "_b"]):
            fp, rep = t.column("fp").to_numpy().view(np.uint64), t.column("rep").to_numpy()
            blk, within = t.column("_blk").to_numpy(), t.column("_a").to_numpy() == t.column("_b").to_numpy()
            us, vs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for i, j in pairs_in_runs(run):
                ok = (np.bitwise_count(fp[i] ^ fp[j]) <= max_bits) & (within[i] | (blk[i] != blk[j]))
                u, v = forest(rep[i[ok]], rep[j[ok]])
                us.append(u)
                vs.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in forest(np.concatenate(us), np.concatenate(vs))],
                                             names=["a", "b"])

    return block_rows(cells, "cell", "fp", block).mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of ``docs``.

    ``component_id`` is the smallest id reachable by links between
    fingerprints at most ``max_bits`` bits apart. Equal fingerprints form one
    class before any comparison, so copies are never paired. Null and blank
    texts have fingerprint zero, linked like any other. Repeated rows stay
    repeated. A row with a null id belongs to its class, whose smallest id is
    taken from the other rows; a class of null ids only has a null
    ``component_id`` and links to nothing. Other columns are ignored.
    """
    found = materialise(fingerprints(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("_text")),
                                     "_text", shingle).drop("_text"), "fingerprints")
    reps = materialise(found.groupBy("fp").agg(F.min("doc_id").alias("rep")), "fingerprint-classes")
    links = linked_fingerprints(reps.filter("rep is not null"), max_bits)
    parts = connected_components(links)
    classes = materialise(reps.join(parts, reps.rep == parts.node, "left")
                          .select("fp", F.coalesce("component", "rep").alias("component_id")), "components")
    return (found.join(classes, "fp")
            .select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id"))
