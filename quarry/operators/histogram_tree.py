"""Decision trees grown level by level from histograms.

A level is one pass over packed blocks: every task finds the node of its rows
in the tree so far and counts (node, feature, bin) cells, n, sum and sum of
squares of the label; the cells are summed and the driver picks each node's
split. A pass costs nodes x features x bins cells, whatever the number of rows. One
tree holds every smaller one: ``at_depth`` reads them off without a new fit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .matrix_gd import Blocks


@dataclass
class Node:
    """Node i has children 2i + 1 and 2i + 2; ``left`` says per bin whether it goes left."""
    n: float
    mean: float
    impurity: float
    feature: int | None = None
    left: np.ndarray | None = None


@dataclass
class Tree:
    nodes: dict[int, Node]
    lows: np.ndarray
    spans: np.ndarray
    bins: int
    categories: dict[int, int] = field(default_factory=dict)

    def bin_of(self, x: np.ndarray) -> np.ndarray:
        """Bins of rows: equal parts of a feature's range (values beyond it in
        the end bins), the category itself of a category; -1 for an unknown category."""
        with np.errstate(invalid="ignore", divide="ignore"):
            out = np.floor((x - self.lows) / self.spans * self.bins)
        out = np.where(self.spans > 0, np.clip(out, 0, self.bins - 1), 0)
        for j, arity in self.categories.items():
            known = (x[:, j] >= 0) & (x[:, j] < arity) & (x[:, j] == np.floor(x[:, j]))
            out[:, j] = np.where(known, x[:, j], -1)
        return out.astype(np.int64)

    def leaf_of(self, x: np.ndarray, depth: int | None = None) -> np.ndarray:
        """The deepest node of each row, at most ``depth`` below the root."""
        where = np.zeros(len(x), np.int64)
        cells = self.bin_of(x)
        for i in sorted(self.nodes):   # parents come before children
            node = self.nodes[i]
            if node.feature is not None and (depth is None or level(i) < depth):
                rows = np.flatnonzero(where == i)
                cell = cells[rows, node.feature]
                where[rows] = 2 * i + 2 - (node.left[cell] & (cell >= 0))
        return where

    def at_depth(self, depth: int) -> Tree:
        """The tree of this depth over the same bins."""
        nodes = {i: n if level(i) < depth else Node(n.n, n.mean, n.impurity) for i, n in self.nodes.items() if level(i) <= depth}
        return Tree(nodes, self.lows, self.spans, self.bins, self.categories)

    def predict(self, df: DataFrame, features: str = "features", out: str = "prediction", depth: int | None = None) -> DataFrame:
        """The rows with the mean of their leaf; null if the features are null, too few, or hold a null."""
        width = len(self.lows)
        at = df.columns.index(features)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = b.column(at).to_pylist()
                whole = [i for i, x in enumerate(rows) if x is not None and len(x) >= width and None not in x[:width]]
                got = np.full(len(rows), np.nan)
                if whole:
                    leaf = self.leaf_of(np.array([rows[i][:width] for i in whole], float), depth)
                    got[whole] = [self.nodes[i].mean for i in leaf.tolist()]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, mask=np.isnan(got))], names=[*b.schema.names, out])

        return df.mapInArrow(run, StructType([*df.schema.fields, StructField(out, DoubleType())]))


def level(node: int) -> int:
    return (node + 1).bit_length() - 1


def grow(df: DataFrame, features: str = "features", label: str = "label", depth: int = 5, bins: int = 32,
         impurity: str = "variance", categories: dict[int, int] | None = None, min_rows: int = 1) -> Tree:
    """A tree of at most ``depth`` levels of splits.

    ``impurity`` is variance (regression), or gini or entropy of a 0/1 label,
    whose leaf means are shares of ones. Numeric features are cut at equal
    parts of their range; ``categories`` gives the arity of features that hold
    category numbers, which are put in the order of their mean label (then
    number) and cut in that order, so any of their bipartitions that lowers a
    variance most is found; unseen categories go right. Splits leave
    ``min_rows`` rows on both sides and lower the impurity; ties go to the
    lower feature, then the earlier cut. Rows with null features or label don't
    count, and a table without rows gives a tree without nodes.
    """
    if impurity not in ("variance", "gini", "entropy"):
        raise ValueError(impurity)
    categories = categories or {}
    with Blocks(df, features, label) as blocks:
        d = blocks.width
        if not blocks.n:
            return Tree({}, np.zeros(d), np.zeros(d), bins, categories)
        x = df.select(F.col(features).alias("x"), F.col(label).alias("y")).filter(
            f"y is not null and size(x) >= {d} and not exists(slice(x, 1, {d}), v -> v is null)")
        ends = x.agg(*[f(F.col("x")[j]).cast("double").alias(f"{n}{j}") for j in range(d) for n, f in (("a", F.min), ("b", F.max))]).first()
        lows = np.array([ends[f"a{j}"] for j in range(d)], float)
        tree = Tree({}, lows, np.array([ends[f"b{j}"] for j in range(d)], float) - lows, bins, categories)
        width = max([bins, *categories.values()])
        open_nodes = [0]
        for now in range(depth + 1):
            cells = _histogram(blocks, tree, open_nodes, now, width)
            following = []
            for i, counts in zip(open_nodes, cells):
                n, s, q = counts[0].sum(axis=0).tolist()   # every feature holds all rows of the node
                node = tree.nodes[i] = Node(n, s / n, float(_impurity(impurity, n, s, q)))
                if now < depth:
                    _split(node, counts, impurity, categories, min_rows)
                if node.feature is not None:
                    following += [2 * i + 1, 2 * i + 2]
            open_nodes = following
            if not open_nodes:
                break
    return tree


def _histogram(blocks: Blocks, tree: Tree, nodes: list[int], now: int, width: int) -> np.ndarray:
    """(node, feature, bin, [n, sum, squares]); the last bin holds unknown categories."""
    d, place = blocks.width, {i: k for k, i in enumerate(nodes)}
    shape = (len(nodes), d, width + 1, 3)

    def of_block(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        leaf = tree.leaf_of(x)
        at = np.array([place.get(i, -1) for i in range(leaf.max() + 1)])[leaf]
        rows = np.flatnonzero(at >= 0)
        cell = tree.bin_of(x[rows])
        cell[cell < 0] = width
        flat = ((at[rows][:, None] * d + np.arange(d)) * (width + 1) + cell).ravel()
        y = np.repeat(y[rows], d)
        return np.stack([np.bincount(flat, w, shape[0] * d * (width + 1)) for w in (None, y, y * y)], axis=-1).ravel()

    return blocks.total(int(np.prod(shape)), of_block).reshape(shape)


def _impurity(kind: str, n, s, q):
    mean = s / n
    if kind == "variance":
        return q / n - mean * mean
    if kind == "gini":
        return 2.0 * mean * (1.0 - mean)
    return -sum(np.where(p > 0, p * np.log2(np.where(p > 0, p, 1.0)), 0.0) for p in (mean, 1.0 - mean))


def _split(node: Node, counts: np.ndarray, kind: str, categories: dict[int, int], min_rows: int) -> None:
    best = None
    for j in range(len(counts)):
        cells = counts[j]
        order = np.arange(len(cells))
        if j in categories:
            with np.errstate(invalid="ignore", divide="ignore"):
                mean = np.where(cells[:, 0] > 0, cells[:, 1] / cells[:, 0], np.inf)
            order = np.lexsort((order, mean))   # empty categories last
        left = np.cumsum(cells[order], axis=0)[:-1]
        right = left[-1] + cells[order][-1] - left
        fine = np.flatnonzero((left[:, 0] >= max(min_rows, 1)) & (right[:, 0] >= max(min_rows, 1)))
        if not len(fine):
            continue
        a, b = left[fine].T, right[fine].T
        if kind == "entropy":
            gain = node.n * node.impurity - a[0] * _impurity(kind, *a) - b[0] * _impurity(kind, *b)
        else:   # what the squares around the means fall by
            gain = a[1] * a[1] / a[0] + b[1] * b[1] / b[0] - (node.n * node.mean) * node.mean
        k = int(np.argmax(gain))
        if gain[k] > 1e-12 * max(1.0, abs(node.n * node.impurity)) and (best is None or gain[k] > best[0]):
            best = (gain[k], j, order[:fine[k] + 1])
    if best is not None:
        node.feature = best[1]
        node.left = np.zeros(counts.shape[1], bool)
        node.left[best[2]] = True
