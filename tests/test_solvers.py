"""Matrix gradient descent, converged solvers and the truncated decomposition against NumPy and the library."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import linear, matrix_gd, solvers


def table(spark, x, y, parts=3):
    rows = [([None if v is None else float(v) for v in r], None if t is None else float(t)) for r, t in zip(x, y)]
    return spark.createDataFrame(rows, "features array<double>, label double").repartition(parts)


def data(n, d, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    return x, x @ rng.standard_normal(d) + rng.standard_normal(n)


@pytest.mark.parametrize("fan", [32, 1])
def test_grid_of_wide_models(spark, monkeypatch, fan):
    """1,000 features, twelve models, sums with and without the tree."""
    monkeypatch.setattr(matrix_gd, "FAN", fan)
    x, y = data(80, 1000)
    y = (y > 0).astype(float)
    df = table(spark, x, y, 4)
    configs = [dict(loss=loss, step=s, iters=3, reg=r, reg_param=0.05, intercept=i)
               for loss in ("logistic", "hinge", "squared") for s, r, i in
               ((0.5, "none", False), (0.1, "l2", True), (0.2, "l1", True), (1.0, "l1", False))]
    models = linear.gd_fit_many(df, configs)
    for c, m in zip(configs, models):
        xx = np.column_stack([x, np.ones(len(x))]) if c["intercept"] else x
        w = np.zeros(xx.shape[1])
        if c["intercept"]:
            w[-1] = 1.0
        for i in range(1, 4):
            z = xx @ w
            err = {"logistic": lambda: 1 / (1 + np.exp(-z)) - y, "squared": lambda: z - y,
                   "hinge": lambda: np.where((2 * y - 1) * z < 1, 1 - 2 * y, 0)}[c["loss"]]()
            g, eta = xx.T @ err / len(y), c["step"] / np.sqrt(i)
            w = w * (1 - eta * 0.05) - eta * g if c["reg"] == "l2" else w - eta * g
            if c["reg"] == "l1":
                w = np.sign(w) * np.maximum(np.abs(w) - eta * 0.05, 0)
        assert np.allclose(m.weights, w, rtol=1e-9, atol=1e-12)
        assert len(m.history) == 4
    got = df.select(models[1].margin(F.col("features")).alias("m"), "features").collect()
    w = np.array(models[1].weights)
    assert np.allclose([r["m"] for r in got], [np.dot(r["features"], w[:-1]) + w[-1] for r in got])


def test_rows_that_do_not_count(spark):
    x = [[1, 2], [None, 1], [3, 4, 9], [5], [0, 1], [2, 2]]
    y = [1, 1, 0, 1, None, 1]
    got = linear.gd_fit(table(spark, x, y, 1), iters=1, step=1.0).weights
    keep = np.array([[1, 2], [3, 4], [2, 2]], float)
    assert np.allclose(got, -keep.T @ (0.5 - np.array([1, 0, 1])) / 3)
    none = table(spark, x, y, 1).filter("false")
    assert linear.gd_fit(none, w0=[1.0, 2.0]).weights == [1.0, 2.0]
    assert linear.gd_fit(none, intercept=True).weights == [1.0]
    with pytest.raises(ValueError):
        linear.gd_fit(table(spark, x, y, 1), loss="other")


def test_normal_equations(spark):
    x, y = data(200, 6)
    fit = solvers.linear_regression(table(spark, x, y))
    xx = np.column_stack([x, np.ones(len(x))])
    assert np.allclose(fit.weights, np.linalg.lstsq(xx, y, rcond=None)[0], atol=1e-9)
    twice = np.column_stack([x, x[:, :1]])   # dependent features: least norm
    assert np.allclose(solvers.linear_regression(table(spark, twice, y)).weights[0], fit.weights[0] / 2, atol=1e-6)
    ridge = solvers.linear_regression(table(spark, x, y), l2=0.3)
    around, mid = x - x.mean(axis=0), y - y.mean()
    want = np.linalg.solve(around.T @ around + 0.3 * len(y) * np.eye(6), around.T @ mid)
    assert np.allclose(ridge.weights[:-1], want, atol=1e-9)
    assert solvers.linear_regression(table(spark, x, y).filter("false")).weights == [0.0]


def test_newton(spark):
    x, y = data(300, 4, 1)
    y = (y + np.random.default_rng(2).standard_normal(300) > 0).astype(float)
    df = table(spark, x, y)
    fit = solvers.logistic_regression(df)
    assert fit.gradient < 1e-10 and fit.passes < 15
    xx = np.column_stack([x, np.ones(len(x))])
    assert np.max(np.abs(xx.T @ (1 / (1 + np.exp(-xx @ np.array(fit.model.weights))) - y))) / 300 < 1e-8
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    lib = LogisticRegression(maxIter=200, tol=1e-12).fit(df.withColumn("features", array_to_vector("features")))
    assert np.allclose(fit.model.weights, [*lib.coefficients.toArray(), lib.intercept], atol=1e-5)
    apart = solvers.logistic_regression(table(spark, [[-1], [-2], [1], [2]], [0, 0, 1, 1]), most=8)
    assert apart.passes <= 8 and np.isfinite(apart.model.weights).all()
    held = solvers.logistic_regression(table(spark, [[-1], [-2], [1], [2]], [0, 0, 1, 1]), l2=0.1)
    assert held.gradient < 1e-10


def svd_table(spark, a, parts=3):
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(a)], "k long, v array<double>").repartition(parts)


@pytest.mark.parametrize("fan", [16, 2])
def test_truncated_svd(spark, monkeypatch, fan):
    monkeypatch.setattr(solvers, "_FAN", fan)
    rng = np.random.default_rng(3)
    a = rng.standard_normal((120, 5)) @ np.diag([9, 5, 3, 2, 1]) @ rng.standard_normal((5, 40)) + 0.01 * rng.standard_normal((120, 40)) + 7
    for centre in (True, False):
        svd = solvers.truncated_svd(svd_table(spark, a, 5), "v", 4, centre=centre)
        want = np.linalg.svd(a - a.mean(axis=0) * centre, full_matrices=False)
        assert np.allclose(svd.values, want[1][:4], rtol=1e-9)
        assert np.allclose(np.abs(svd.right.T @ want[2][:4].T), np.eye(4), atol=1e-6)
        u = np.array([r["u"] for r in svd.left(svd_table(spark, a), "k", "v").orderBy("k").collect()])
        assert np.allclose(u.T @ u, np.eye(4), atol=1e-6)
        assert np.allclose((u * svd.values) @ svd.right.T, (want[0][:, :4] * want[1][:4]) @ want[2][:4], atol=1e-5)


def test_svd_edges(spark):
    low = svd_table(spark, np.outer(np.arange(6.0), [1.0, 2.0, 2.0]))
    svd = solvers.truncated_svd(low, "v", 3, centre=False)
    assert np.allclose(svd.values, [np.sqrt(55) * 3, 0, 0], atol=1e-6)
    rows = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [None, 1.0]), (4, [0.0, 2.0])], "k long, v array<double>")
    got = solvers.truncated_svd(rows, "v", 2, centre=False)
    assert np.allclose(got.values, [2, 1])
    assert {r["k"]: r["u"] is None for r in got.left(rows, "k", "v").collect()} == {1: False, 2: True, 3: True, 4: False}
    assert solvers.truncated_svd(rows.filter("false"), "v", 2).values.tolist() == []


def test_wide_svd(spark):
    """2,500 features, where a d x d matrix would have six million entries."""
    rng = np.random.default_rng(5)
    a = rng.standard_normal((60, 3)) @ np.diag([5, 3, 2]) @ rng.standard_normal((3, 2500))
    svd = solvers.truncated_svd(svd_table(spark, a), "v", 3)
    assert np.allclose(svd.values, np.linalg.svd(a - a.mean(axis=0), compute_uv=False)[:3], rtol=1e-8)
