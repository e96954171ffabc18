"""Near-duplicate vectors by cross-polytope hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import block_rows, forest, materialise, pairs_in_runs, runs
from .components import connected_components


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (length a power of two), scaled to keep lengths."""
    n, d = x.shape
    half = 1
    while half < d:
        y = x.reshape(n, d // (2 * half), 2, half)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(n, d)
        half *= 2
    return x / np.sqrt(d)


def polytope_keys(x: np.ndarray, tables: int, hashes: int, probes: int, seed: int) -> np.ndarray:
    """Bucket codes (rows, tables * probes) of unit vectors.

    A hash is the nearest signed axis after three rounds of random signs and
    a Hadamard transform; a table joins ``hashes`` of them. Further probes
    replace the nearest axes by the next ones, cheapest replacement first.
    """
    n, dim = x.shape
    d = 1 << max(1, (dim - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, d - dim)))
    rng = np.random.default_rng(seed)
    near = min(3, d)
    out = np.empty((n, tables * probes), dtype=np.int64)
    choices = np.array(np.meshgrid(*[np.arange(near)] * hashes, indexing="ij")).reshape(hashes, -1).T
    for t in range(tables):
        code = np.full((n, len(choices)), t, dtype=np.int64)
        cost = np.zeros((n, len(choices)))
        for h in range(hashes):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], d))
            axis = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :near]
            value = np.take_along_axis(y, axis, 1)
            axis = 2 * axis + (value < 0)
            gap = (np.abs(value[:, :1]) - np.abs(value)) ** 2
            code = code * (2 * d) + axis[:, choices[:, h]]
            cost += gap[:, choices[:, h]]
        best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        out[:, t * probes:t * probes + best.shape[1]] = np.take_along_axis(code, best, 1)
        out[:, t * probes + best.shape[1]:(t + 1) * probes] = code[:, :1]
    return out


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding",
                    label: str = "label", threshold: float = 0.98, tables: int = 6, hashes: int = 2,
                    probes: int = 2, seed: int = 7, block: int = 512) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``vectors``.

    Two vectors are linked when their labels are equal and not null and their
    cosine in double precision is at least ``threshold``. Pairs come from
    cross-polytope buckets: every vector enters its ``probes`` nearest buckets
    of each table, vectors that share a bucket are compared exactly, and a
    pair counts in the smallest of its common buckets only. Equal vectors of a
    label are one class, found exactly and never paired; classes carry their
    row counts, so ``n_links`` counts rows.

    Large buckets are dealt to bounded blocks (``block`` vectors); a block
    sends back link counts and a spanning forest. Recall at the defaults is measured
    in the tests on planted links, as the given tables hold few or none.

    Vectors that are null, zero, empty or hold null or non-finite components,
    rows with a null label, and rows with a null id link with nothing
    (n_links 0, their own component; kept is false for a null id). Vectors of
    different lengths never link. Repeated rows are linked copies; rows of one
    id with different vectors are rows of their own. Other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label).alias("_label"),
                          F.col(vector).cast("array<double>").alias("_v"))
    usable = (F.col("vec_id").isNotNull() & F.col("_label").isNotNull() & F.col("_v").isNotNull()
              & ~F.exists("_v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
              & F.exists("_v", lambda e: e != 0))
    rows = rows.withColumn("_ok", F.coalesce(usable, F.lit(False)))
    good = rows.filter("_ok")
    # classes are numbered: an id may have several vectors, and then names several classes
    classes = good.groupBy("_label", "_v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("w"))
    classes = materialise(classes.withColumn("rep", F.monotonically_increasing_id()), "vector-classes")
    links = materialise(_links(classes, threshold, tables, hashes, probes, seed, block), "vector-links")
    counts = links.filter("b is null").groupBy("a").agg(F.sum("n").alias("others"))
    parts = connected_components(links.filter("b is not null"))
    known = materialise(classes.join(counts, classes.rep == counts.a, "left")
                        .join(parts, classes.rep == parts.node, "left")
                        .select("_label", "_v", (F.col("w") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                                F.coalesce("component", "rep").alias("part"), "least"), "vector-components")
    first = known.groupBy("part").agg(F.min("least").alias("component_id"))
    known = materialise(known.join(first, "part").drop("part", "least"), "vector-results")
    linked = good.join(known, ["_label", "_v"]).select("vec_id", "n_links", "component_id")
    single = rows.filter(~F.col("_ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                               F.col("vec_id").alias("component_id"))
    return linked.union(single).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _links(classes: DataFrame, threshold, tables, hashes, probes, seed, block) -> DataFrame:
    """(a, b, n): rows with b are links for components; rows without b add n to a's link count."""
    kind = F.xxhash64("_label", F.size("_v"))

    def hashed(batches):
        for b in batches:
            rep, flat = b.column("rep"), b.column("_v")
            size = np.asarray(flat.value_lengths()) if b.num_rows else np.empty(0, int)
            codes = [None] * b.num_rows
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                x = np.array(flat.take(pa.array(at)).flatten(), dtype=float).reshape(len(at), d)
                x = _unit(x)
                for i, row in zip(at, polytope_keys(x, tables, hashes, probes, seed + int(d))):
                    codes[i] = row
            yield pa.RecordBatch.from_arrays([rep, pa.array(codes, type=pa.list_(pa.int64()))], names=["rep", "codes"])

    keyed = classes.select("rep", "_v").mapInArrow(hashed, "rep long, codes array<long>")
    # buckets use a hash of the label and the length, compared pairs check both themselves
    vecs = classes.select("rep", "_v", "w", "_label", kind.alias("_kind"))
    vecs = vecs.join(keyed, "rep").withColumn("keys", F.array_sort(F.transform("codes", lambda c: F.xxhash64("_kind", c))))
    vecs = materialise(vecs.drop("codes"), "vector-keys")
    entered = vecs.select("rep", F.explode(F.array_distinct("keys")).alias("key"))
    busy = entered.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    busy = materialise(busy, "busy-buckets")  # written, so that AQE can split the rows of a hot bucket in the join
    met = (entered.join(busy, "key").groupBy("rep").agg(F.collect_list("key").alias("met")))
    cells = vecs.join(met, "rep").select("rep", "w", "_v", F.col("_label").cast("string").alias("_label"), "keys",
                                         F.explode("met").alias("key"))

    def compare(batches):
        for t, run in runs(batches, ["key", "_a", "_b"]):
            multi = np.bincount(run)[run] > 1
            if not multi.any():
                continue
            t, run = t.filter(pa.array(multi)).combine_chunks(), run[multi]
            rep, w, key, blk = (t.column(c).to_numpy() for c in ("rep", "w", "key", "_blk"))
            within = t.column("_a").to_numpy() == t.column("_b").to_numpy()
            label = t.column("_label").combine_chunks().dictionary_encode().indices.to_numpy() \
                if t.num_rows else np.empty(0, int)
            vec, size = _matrix(t.column("_v").combine_chunks())
            keys, _ = _matrix(t.column("keys").combine_chunks())
            add = np.zeros(t.num_rows, dtype=np.int64)
            us, vs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for i, j in pairs_in_runs(run, 1 << 16):
                ok = (within[i] | (blk[i] != blk[j])) & (label[i] == label[j]) & (size[i] == size[j])
                i, j = i[ok], j[ok]
                ok = np.einsum("ij,ij->i", vec[i], vec[j]) >= threshold
                i, j = i[ok], j[ok]
                same = keys[i][:, :, None] == keys[j][:, None, :]
                first = np.where(same.any(2), keys[i], np.iinfo(np.int64).max).min(1)
                ok = first == key[i]
                i, j = i[ok], j[ok]
                np.add.at(add, i, w[j])
                np.add.at(add, j, w[i])
                u, v = forest(rep[i], rep[j])
                us.append(u)
                vs.append(v)
            u, v = forest(np.concatenate(us), np.concatenate(vs))
            got = np.flatnonzero(add)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([u, rep[got]])),
                 pa.concat_arrays([pa.array(v, type=pa.int64()), pa.nulls(len(got), pa.int64())]),
                 pa.array(np.concatenate([np.zeros(len(u), np.int64), add[got]]))], names=["a", "b", "n"])

    return block_rows(cells, "key", "rep", block).mapInArrow(compare, "a long, b long, n long")


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # first by the largest part: squares of tiny or huge parts stay finite
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _matrix(lists) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column, padded with zeros to the longest; their lengths."""
    arr = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    size = np.asarray(arr.value_lengths())
    flat = np.asarray(arr.flatten())
    wide = int(size.max(initial=0))
    out = np.zeros((len(size), wide), dtype=flat.dtype)
    out[np.arange(wide)[None, :] < size[:, None]] = flat
    if out.dtype == float and len(out):
        out = _unit(out)
    return out, size
