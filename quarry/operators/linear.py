"""Linear models by full-batch gradient descent (logistic, hinge, squared
loss) with none / L1 / L2 updaters and step / sqrt(iteration) decay.

The descent itself works on packed blocks (``matrix_gd``); scores are column
expressions over the fitted weights.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from . import matrix_gd

#: Wider models score by one array product instead of a term a feature.
WIDE = 32


@dataclass
class LinearModel:
    weights: list[float]
    intercept: bool
    loss: str
    history: list[list[float]] = field(default_factory=list)

    def margin(self, features: Column) -> Column:
        return margin_expr(self.weights, features, self.intercept)

    def score(self, features: Column) -> Column:
        m = self.margin(features)
        if self.loss == "logistic":
            return F.lit(1.0) / (F.lit(1.0) + F.exp(-m))
        return m

    def predict(self, features: Column, threshold: float | None = None) -> Column:
        if self.loss == "squared":
            return self.margin(features)
        if self.loss == "logistic":
            t = 0.5 if threshold is None else threshold
            return (self.score(features) > t).cast("double")
        t = 0.0 if threshold is None else threshold
        return (self.margin(features) > t).cast("double")


def margin_expr(w: list[float], features: Column, intercept: bool) -> Column:
    d = len(w) - (1 if intercept else 0)
    if d > WIDE:
        known = F.array(*[F.lit(float(v)) for v in w[:d]])
        dot = V.dot(F.slice(features, 1, d), known)
        return F.when(F.size(features) >= d, dot + F.lit(float(w[d])) if intercept else dot)
    m = F.lit(float(w[d])) if intercept else F.lit(0.0)
    for j in range(d):
        m = m + F.lit(float(w[j])) * features.getItem(j)
    return m


def gd_fit(df: DataFrame, features: str = "features", label: str = "label", loss: str = "logistic",
           step: float = 1.0, iters: int = 10, reg: str = "none", reg_param: float = 0.0,
           intercept: bool = False, w0: list[float] | None = None) -> LinearModel:
    """One model; see ``gd_fit_many``."""
    config = dict(loss=loss, step=step, iters=iters, reg=reg, reg_param=reg_param, intercept=intercept)
    return gd_fit_many(df, [config], features, label, [w0])[0]


def weights_frame(spark, model: LinearModel, name: str) -> DataFrame:
    """(model, j, weight, is_zero): the fitted weights as a small DataFrame
    (the intercept, when present, is the last index)."""
    rows = [(name, j, float(v), v == 0.0) for j, v in enumerate(model.weights)]
    return spark.createDataFrame(rows, "model string, j int, weight double, is_zero boolean")


def gd_fit_many(df: DataFrame, configs: list[dict], features: str = "features", label: str = "label",
                starts: list[list[float] | None] | None = None) -> list[LinearModel]:
    """Full-batch gradient descent of several models over the same rows;
    ``features`` is an array of numbers.

    Each config takes loss, step, iters, reg, reg_param and intercept. The
    rows are packed once and read once per iteration for all models (once in
    all for the squared loss). Rows with a null label or feature don't count;
    of an empty table the start weights come back.
    """
    cfgs = [dict(dict(loss="logistic", step=1.0, iters=10, reg="none", reg_param=0.0, intercept=False), **c)
            for c in configs]
    starts = starts or [None] * len(cfgs)
    with matrix_gd.Blocks(df, features, label) as blocks:
        d = blocks.width
        if blocks.frame is None:   # no row says how many features there are
            d = max((len(w) - c["intercept"] for w, c in zip(starts, cfgs) if w is not None), default=0)
        # zero start; the intercept weight starts at 1.0 because the bias
        # column is appended to the initial weights as well (library convention)
        begun = [[0.0] * d + [1.0] * c["intercept"] if w is None else list(w) for w, c in zip(starts, cfgs)]
        bias = [np.array(w if c["intercept"] else [*w, 0.0], float) for w, c in zip(begun, cfgs)]
        paths = matrix_gd.descend(blocks, cfgs, bias)
    kept = [[[float(v) for v in (w if c["intercept"] else w[:-1])] for w in path] for path, c in zip(paths, cfgs)]
    return [LinearModel(path[-1], c["intercept"], c["loss"], path) for path, c in zip(kept, cfgs)]
