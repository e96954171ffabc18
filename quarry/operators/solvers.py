"""Solvers that run to convergence on packed blocks: normal equations, Newton
steps, and truncated singular values by block power iterations.

Only matrices of model size (features x features, or features x k) reach the
driver; every pass over the rows is one job over the kept blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .linear import LinearModel
from .matrix_gd import Blocks, products


def linear_regression(df: DataFrame, features: str = "features", label: str = "label", l2: float = 0.0) -> LinearModel:
    """Least squares with an intercept from X'X and X'y, one pass over the rows.

    ``l2`` is added to the mean squares of the features, not to the
    intercept's. Of dependent features the solution of least norm is taken.
    No complete row gives zero weights.
    """
    with Blocks(df, features, label) as blocks:
        if not blocks.n:
            return LinearModel([0.0] * (blocks.width + 1), True, "squared")
        xx, xy = products(blocks)
        ridge = np.append(np.full(blocks.width, l2 * blocks.n), 0.0)
        w = np.linalg.lstsq(xx + np.diag(ridge), xy, rcond=None)[0]
    return LinearModel(w.tolist(), True, "squared")


@dataclass
class NewtonFit:
    model: LinearModel
    passes: int
    gradient: float     # largest entry of the mean gradient at the last weights


def logistic_regression(df: DataFrame, features: str = "features", label: str = "label", l2: float = 0.0,
                        tol: float = 1e-10, most: int = 50) -> NewtonFit:
    """Logistic regression with an intercept by Newton steps (iteratively
    reweighted least squares): a pass adds up X'WX, X'(p - y) and the loss.

    A step that does not lower the loss is halved, so a poor start does not
    diverge. Stops when the mean gradient is at most ``tol``, or after
    ``most`` passes: with separable classes and no ``l2`` the weights grow
    without end, and ``gradient`` tells how far it came. Labels above one half count as 1.
    """
    with Blocks(df, features, label) as blocks:
        d = blocks.width + 1
        ridge = np.append(np.full(d - 1, l2), 0.0)

        def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
            def of_block(x: np.ndarray, y: np.ndarray) -> np.ndarray:
                x, y = np.column_stack([x, np.ones(len(x))]), (y > 0.5).astype(float)
                m = x @ w
                p = 0.5 * (1.0 + np.tanh(0.5 * m))
                loss = np.sum(np.logaddexp(0.0, m) - y * m)
                return np.concatenate([[loss], x.T @ (p - y), (x.T @ (x * (p * (1.0 - p))[:, None])).ravel()])
            t = blocks.total(1 + d + d * d, of_block) / max(blocks.n, 1)
            return t[0] + 0.5 * ridge @ (w * w), t[1:1 + d] + ridge * w, t[1 + d:].reshape(d, d) + np.diag(ridge)

        w = np.zeros(d)
        loss, g, h = at(w)
        passes = 1
        while np.max(np.abs(g), initial=0.0) > tol and passes < most:
            step = np.linalg.lstsq(h, g, rcond=None)[0]
            while passes < most:
                new = at(w - step)
                passes += 1
                if new[0] <= loss + 1e-12 * abs(loss):
                    break
                step = step / 2
            if new[0] > loss + 1e-12 * abs(loss):
                break
            w, (loss, g, h) = w - step, new
    return NewtonFit(LinearModel(w.tolist(), True, "logistic"), passes, float(np.max(np.abs(g), initial=0.0)))


@dataclass
class TruncatedSvd:
    values: np.ndarray      # k singular values, falling
    right: np.ndarray       # d x k
    mean: np.ndarray        # subtracted from every row
    passes: int

    def left(self, df: DataFrame, key: str, vec: str) -> DataFrame:
        """(key, u): the rows of U, computed where the rows are. A row that was
        not complete has a null u; so has every row's entry of a value of zero
        the value 0."""
        scale = np.divide(1.0, self.values, out=np.zeros_like(self.values), where=self.values > 0)
        onto, shift, d = self.right * scale, self.mean, len(self.right)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = [np.array(x[:d], float) if x is not None and len(x) >= d and None not in x[:d] else None
                        for x in b.column(1).to_pylist()]
                u = [None if x is None else ((x - shift) @ onto).tolist() for x in rows]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(u, pa.list_(pa.float64()))], names=[key, "u"])

        typ = df.schema[key].dataType.simpleString()
        return df.select(key, F.col(vec).cast("array<double>")).mapInArrow(run, f"`{key}` {typ}, u array<double>")


def truncated_svd(df: DataFrame, vec: str, k: int, centre: bool = True, extra: int = 8, tol: float = 1e-10,
                  most: int = 200) -> TruncatedSvd:
    """The ``k`` largest singular values and right vectors of the (centred)
    rows, without a d x d matrix.

    Block power iterations with ``extra`` more columns: a pass sends a d x
    (k + extra) matrix V, adds up A'(A V) over the blocks, and the driver makes
    its columns orthonormal. It ends when no value changes by more than ``tol``
    (relative to the largest), or after ``most`` passes. The last pass is a tall and skinny QR of A V: each task
    reduces its rows to one triangle, and triangles are reduced pairwise by
    the same step, so values come from A itself and not from squares of it.
    The start is fixed, so reruns differ by the order of sums alone. Signs: the
    largest entry of a right vector is positive.
    """
    rows = df.select(F.col(vec).cast("array<double>").alias("features"), F.lit(0.0).alias("label"))
    with Blocks(rows) as blocks:
        d = blocks.width
        k = min(k, d)
        wide = min(k + extra, d)
        if not blocks.n:
            return TruncatedSvd(np.zeros(k), np.eye(d, k), np.zeros(d), 0)
        mean = blocks.total(d, lambda x, y: x.sum(axis=0)) / blocks.n if centre else np.zeros(d)
        v = np.linalg.qr(np.random.default_rng(0).standard_normal((d, wide)))[0]
        before = np.zeros(wide)
        passes = 0
        while passes < most:
            def of_block(x: np.ndarray, y: np.ndarray, v: np.ndarray = v) -> np.ndarray:
                x = x - mean
                return (x.T @ (x @ v)).ravel()
            z = blocks.total(d * wide, of_block).reshape(d, wide)
            passes += 1
            v, r = np.linalg.qr(z)
            now = np.sort(np.abs(np.diag(r)))[::-1]
            if np.max(np.abs(now - before)[:k]) <= tol * max(now[0], np.finfo(float).tiny):
                break
            before = now
        triangle = _triangle(blocks, v, mean)
    _, s, w = np.linalg.svd(triangle)
    right = v @ w.T
    right *= np.where(right[np.argmax(np.abs(right), axis=0), np.arange(wide)] < 0, -1.0, 1.0)
    return TruncatedSvd(s[:k], right[:, :k], mean, passes)


def _triangle(blocks: Blocks, v: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """R of the QR of (A - mean) V: a triangle a task, reduced in rounds of ``_FAN`` triangles."""
    width, wide = blocks.width, v.shape[1]

    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, wide))
        for b in batches:
            for n, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held = np.linalg.qr(np.vstack([held, (np.frombuffer(x).reshape(n, width) - mean) @ v]), mode="r")
        yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], names=["r"])

    def of_triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, wide))
        for b in batches:
            for r in b.column(0).to_pylist():
                held = np.linalg.qr(np.vstack([held, np.frombuffer(r).reshape(-1, wide)]), mode="r")
        if len(held):
            yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], names=["r"])

    triangles, tasks = blocks.frame.mapInArrow(of_rows, "r binary"), blocks.tasks
    while tasks > _FAN:
        tasks = -(-tasks // _FAN)
        triangles = triangles.repartition(tasks).mapInArrow(of_triangles, "r binary")
    parts = [np.frombuffer(row["r"]).reshape(-1, wide) for row in triangles.collect()]   # at most _FAN triangles
    r = np.linalg.qr(np.vstack(parts), mode="r")
    return np.vstack([r, np.zeros((wide - len(r), wide))])


_FAN = 16
