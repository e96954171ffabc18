"""Principal components and singular values.

The d x d Gramian of the centred rows is the only thing that leaves the
executors: every partition multiplies its own block (NumPy inside the task),
and the per-partition results, d rows of d numbers, are dealt by row and
summed there. The eigen-decomposition of that d x d matrix is model-sized driver work.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from .common import attach_row


def column_means(df: DataFrame, vec: str) -> DataFrame:
    """One row: ``_mean`` array of per-dimension means."""
    x = df.select(F.posexplode(V.as_doubles(F.col(vec))).alias("dim", "x"))
    s = x.groupBy("dim").agg(F.avg("x").alias("m"))
    return s.agg(F.array_sort(F.collect_list(F.struct("dim", "m"))).alias("_s")).select(
        F.col("_s.m").alias("_mean"))


def gramian_rows(df: DataFrame, vec: str, centre: bool = True) -> DataFrame:
    """(i, row): the Gramian of the (centred) rows, one array of d values a row.

    A partition ships d packed rows, whatever its number of input rows; a task
    of the sum holds only the matrix rows dealt to it.
    """
    x = df.select(V.as_doubles(F.col(vec)).alias("_x"))
    if centre:
        x = attach_row(x, column_means(df, vec)).select(
            F.zip_with("_x", "_mean", lambda a, m: a - m).alias("_x"))

    def block(it):
        import pandas as pd
        acc = None
        for pdf in it:
            if len(pdf) == 0:
                continue
            m = np.vstack(pdf["_x"].to_numpy())
            g = m.T @ m
            acc = g if acc is None else acc + g
        if acc is not None:
            yield pd.DataFrame({"i": np.arange(len(acc), dtype="int32"), "row": list(acc)})

    def add(it):
        import pandas as pd
        acc: dict = {}
        for pdf in it:
            for i, row in zip(pdf["i"], pdf["row"]):
                acc[i] = acc[i] + row if i in acc else np.array(row)
        if acc:
            yield pd.DataFrame({"i": np.array(list(acc), dtype="int32"), "row": list(acc.values())})

    schema = "i int, row array<double>"
    return x.mapInPandas(block, schema).repartition("i").mapInPandas(add, schema)


def gramian(df: DataFrame, vec: str, centre: bool = True) -> DataFrame:
    """Long (i, j, value) Gramian of the (centred) rows."""
    return gramian_rows(df, vec, centre).select("i", F.posexplode("row").alias("j", "value"))


def gramian_matrix(rows: DataFrame) -> np.ndarray:
    """Collect the d rows of ``gramian_rows`` (model-sized) into a NumPy matrix."""
    return np.array([r["row"] for r in sorted(rows.collect(), key=lambda r: r["i"])])


def svd_from_gramian(g: np.ndarray, k: int):
    """Top-k singular values and right singular vectors (columns) of the
    centred data matrix from its Gramian."""
    w, v = np.linalg.eigh(g)
    order = np.argsort(w)[::-1][:k]
    s = np.sqrt(np.clip(w[order], 0.0, None))
    return s, v[:, order]


def fit_pca(df: DataFrame, vec: str, k: int):
    """``ml.feature.PCA``: components from the covariance of the rows."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector
    data = df.withColumn("_features", array_to_vector(V.as_doubles(F.col(vec))))
    model = PCA(k=k, inputCol="_features", outputCol="_pca").fit(data)
    return model


def components_frame(spark, comps: np.ndarray) -> DataFrame:
    """(component, index, value) from a d x k matrix (model-sized)."""
    rows = [(int(c), int(i), float(comps[i, c])) for c in range(comps.shape[1]) for i in range(comps.shape[0])]
    return spark.createDataFrame(rows, "component int, index int, value double")


def project(df: DataFrame, key: str, vec: str, comps: np.ndarray, centre_row: DataFrame | None = None) -> DataFrame:
    """(key, component, value): rows (optionally centred) times the d x k
    component matrix, inlined as literals (k dot products per row)."""
    x = V.as_doubles(F.col(vec))
    base = df.select(key, x.alias("_x"))
    if centre_row is not None:
        base = attach_row(base, centre_row).select(key, F.zip_with("_x", "_mean", lambda a, m: a - m).alias("_x"))
    cols = [V.dot(F.col("_x"), F.array(*[F.lit(float(v)) for v in comps[:, c]])).alias(f"c{c}")
            for c in range(comps.shape[1])]
    wide = base.select(key, F.array(*cols).alias("_p"))
    return wide.select(key, F.posexplode("_p").alias("component", "value"))


def approx_equal_abs(a, b, tol: float):
    """|a| and |b| within tol (sign ignored)."""
    return F.abs(F.abs(a) - F.abs(b)) <= F.lit(tol)
