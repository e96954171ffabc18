"""Decision trees (``pyspark.ml``) with impurity / depth / bins sweeps,
categorical features declared by an arity map, and model introspection (depth, node count)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V


def vectors(df: DataFrame, features: str, arities: dict[int, int] | None = None, width: int | None = None) -> DataFrame:
    """``_fv``: the features as a vector. ``arities`` declares which positions
    are categorical and how many 0-based codes each has; the data are not
    looked at, so the same feature is of the same kind in every run."""
    from pyspark.ml.functions import array_to_vector
    fv = array_to_vector(V.as_doubles(F.col(features)))
    if not arities:
        return df.withColumn("_fv", fv)
    attrs = {"nominal": [{"idx": j, "vals": [str(c) for c in range(n)]} for j, n in sorted(arities.items())],
             "numeric": [{"idx": j} for j in range(width) if j not in arities]}
    return df.withColumn("_fv", fv.alias("_fv", metadata={"ml_attr": {"attrs": attrs, "num_attrs": width}}))


def fit_classifier(df: DataFrame, features: str, label: str, impurity: str, max_depth: int,
                   max_bins: int = 32):
    from pyspark.ml.classification import DecisionTreeClassifier
    dt = DecisionTreeClassifier(featuresCol="_fv", labelCol=label, impurity=impurity, maxDepth=max_depth,
                                maxBins=max_bins, seed=42)
    data = vectors(df, features)
    return dt.fit(data), data


def fit_regressor(df: DataFrame, features: str, label: str, max_depth: int, max_bins: int = 32,
                  arities: dict[int, int] | None = None, width: int | None = None):
    """Regression tree; ``arities`` ({position: number of codes}) declares the
    categorical features of a vector of ``width`` positions, all others are
    continuous. ``max_bins`` must reach the largest arity."""
    from pyspark.ml.regression import DecisionTreeRegressor
    dt = DecisionTreeRegressor(featuresCol="_fv", labelCol=label, maxDepth=max_depth, maxBins=max_bins, seed=42)
    data = vectors(df, features, arities, width)
    return dt.fit(data), data


def introspect(tree_model) -> dict:
    return {"depth": int(tree_model.depth), "num_nodes": int(tree_model.numNodes)}
