"""Gradient descent of many linear models at once, by matrix products.

Rows are packed once into blocks of plain doubles. An iteration sends the
weights of all models as one matrix, multiplies it with every block (one
product for the margins, one for the gradients) and adds the partial
gradients up, in a tree when there are many tasks. The plan is the same in
every iteration, so nothing is compiled again, and neither the number of
features nor of models is written into expressions.

The squared loss needs no iteration over the rows: its gradient at any weights
follows from X'X, X'y and n, which one pass adds up while the features are at
most ``PRODUCTS`` in number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Partial sums that the driver adds itself, and doubles of a chunk beyond that.
FAN, CHUNK = 32, 4096
LOSSES = ("logistic", "hinge", "squared")
#: Widest X'X (its square is summed and sent to the driver).
PRODUCTS = 512


class Blocks:
    """Complete rows of a table as blocks of doubles, kept for the iterations.

    ``width`` is the number of features of the first row; longer rows are cut
    to it, and rows with less or null features or a null label don't count.
    Use as a context manager: the blocks are released at its end.
    """

    def __init__(self, df: DataFrame, features: str = "features", label: str = "label"):
        rows = df.select(F.col(features).cast("array<double>").alias("x"), F.col(label).cast("double").alias("y"))
        first = rows.select(F.size("x").alias("d")).first()
        self.width = 0 if first is None else max(int(first["d"]), 0)
        self.n = self.tasks = 0
        self.frame = None
        if first is not None:
            self.frame = rows.mapInArrow(_pack(self.width), "n int, x binary, y binary").persist(StorageLevel.MEMORY_AND_DISK)
            sizes = self.frame.groupBy(F.spark_partition_id().alias("task")).agg(F.sum("n").alias("n"))
            seen = sizes.agg(F.count(F.lit(1)).alias("tasks"), F.sum("n").alias("n")).first()
            self.tasks, self.n = int(seen["tasks"]), int(seen["n"] or 0)

    def __enter__(self) -> Blocks:
        return self

    def __exit__(self, *_) -> None:
        if self.frame is not None:
            self.frame.unpersist()

    def total(self, size: int, of_block: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all blocks of ``of_block(x, y)``, an array of ``size`` doubles."""
        if not self.n:
            return np.zeros(size)
        chunk = size if self.tasks <= FAN else min(size, CHUNK)
        sums = self.frame.mapInArrow(_partial(self.width, of_block, size, chunk), _SUMS)
        if self.tasks > FAN:
            sums = sums.repartition("chunk").mapInArrow(_add, _SUMS)
        out = np.zeros(size)
        for r in sums.collect():   # a sum, or at most FAN partial ones
            part = np.frombuffer(r["v"])
            out[r["chunk"] * chunk:r["chunk"] * chunk + len(part)] += part
        return out


_SUMS = "chunk int, v binary"


def _pack(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = b.column(0), b.column(1)
            lengths = x.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
            values = x.flatten()
            at = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.maximum(lengths, 0))])
            bad = np.concatenate([np.zeros(1, np.int64), np.cumsum(values.is_null().to_numpy(zero_copy_only=False))])
            rows = np.flatnonzero((lengths >= width) & y.is_valid().to_numpy(zero_copy_only=False))
            rows = rows[bad[at[rows] + width] == bad[at[rows]]]
            if len(rows):
                flat = values.to_numpy(zero_copy_only=False)
                block = flat[at[rows][:, None] + np.arange(width)]
                label = y.to_numpy(zero_copy_only=False)[rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(rows)], pa.int32()), pa.array([block.astype(np.float64).tobytes()], pa.binary()),
                     pa.array([label.astype(np.float64).tobytes()], pa.binary())], names=["n", "x", "y"])
    return run


def _rows(chunks: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([i for i, _ in chunks], pa.int32()),
                                       pa.array([v.tobytes() for _, v in chunks], pa.binary())], names=["chunk", "v"])


def _partial(width: int, of_block, size: int, chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size)
        for b in batches:
            for n, x, y in zip(*(b.column(i).to_pylist() for i in range(3))):
                out += of_block(np.frombuffer(x).reshape(n, width), np.frombuffer(y))
        yield _rows([(i // chunk, out[i:i + chunk]) for i in range(0, size, chunk)])
    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            held[i] = held[i] + np.frombuffer(v) if i in held else np.frombuffer(v)
    if held:
        yield _rows(list(held.items()))


def products(blocks: Blocks) -> tuple[np.ndarray, np.ndarray]:
    """X'X and X'y with a column of ones appended to X, in one pass."""
    d = blocks.width + 1

    def of_block(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        x = np.column_stack([x, np.ones(len(x))])
        return np.concatenate([(x.T @ x).ravel(), x.T @ y])

    total = blocks.total(d * d + d, of_block)
    return total[:d * d].reshape(d, d), total[d * d:]


def error_matrix(losses: list[str], margin: np.ndarray, y: np.ndarray) -> np.ndarray:
    """d loss / d margin, rows by models."""
    out = margin - y[:, None]
    for m, loss in enumerate(losses):
        if loss == "logistic":
            with np.errstate(over="ignore"):
                out[:, m] = 1.0 / (1.0 + np.exp(-margin[:, m])) - y
        elif loss == "hinge":
            sign = 2.0 * y - 1.0
            out[:, m] = np.where(sign * margin[:, m] < 1.0, -sign, 0.0)
    return out


def mean_gradients(blocks: Blocks, weights: np.ndarray, losses: list[str]) -> np.ndarray:
    """Mean gradient of each model (a row of ``weights``: features, then bias)."""
    d = blocks.width

    def of_block(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        err = error_matrix(losses, x @ weights[:, :d].T + weights[:, d], y)
        return np.column_stack([err.T @ x, err.sum(axis=0)]).ravel()

    return blocks.total(weights.size, of_block).reshape(weights.shape) / blocks.n


def descend(blocks: Blocks, configs: list[dict], starts: list[np.ndarray]) -> list[list[np.ndarray]]:
    """The weights (features, then bias) of each model after 0, 1, ... iterations.

    A config has loss, step, iters, reg, reg_param and intercept; without an
    intercept the bias stays where it started.
    """
    for c in configs:
        if c["loss"] not in LOSSES:
            raise ValueError(c["loss"])
    history = [[np.asarray(w, float)] for w in starts]
    if not blocks.n:
        return history
    one_pass = [m for m, c in enumerate(configs) if c["loss"] == "squared" and blocks.width <= PRODUCTS]
    if one_pass:
        xx, xy = products(blocks)
        for m in one_pass:
            for i in range(1, configs[m]["iters"] + 1):
                w = history[m][-1]
                history[m].append(_update(w, (xx @ w - xy) / blocks.n, configs[m], i))
    others = [m for m in range(len(configs)) if m not in set(one_pass)]
    for i in range(1, max((configs[m]["iters"] for m in others), default=0) + 1):
        live = [m for m in others if i <= configs[m]["iters"]]
        g = mean_gradients(blocks, np.array([history[m][-1] for m in live]), [configs[m]["loss"] for m in live])
        for m, row in zip(live, g):
            history[m].append(_update(history[m][-1], row, configs[m], i))
    return history


def _update(w: np.ndarray, g: np.ndarray, c: dict, i: int) -> np.ndarray:
    """Updater of iteration i (from 1): step / sqrt(i); the bias is regularised like the rest."""
    eta, lam = c["step"] / np.sqrt(i), c["reg_param"]
    if c["reg"] == "none":
        new = w - eta * g
    elif c["reg"] == "l2":
        new = w * (1.0 - eta * lam) - eta * g
    elif c["reg"] == "l1":
        new = w - eta * g
        new = np.sign(new) * np.maximum(np.abs(new) - eta * lam, 0.0)
    else:
        raise ValueError(c["reg"])
    if not c["intercept"]:
        new[-1] = w[-1]
    return new
