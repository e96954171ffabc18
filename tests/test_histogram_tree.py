"""Histogram trees against a plain search over all cuts, and the library."""

import itertools

import numpy as np
import pytest

from quarry.operators import histogram_tree as ht


def table(spark, x, y):
    rows = [([None if v is None else float(v) for v in r], None if t is None else float(t)) for r, t in zip(x, y)]
    return spark.createDataFrame(rows, "features array<double>, label double").repartition(3)


def sse(y):
    return float(np.sum((y - y.mean()) ** 2)) if len(y) else 0.0


def plain(x, y, depth, node=0, out=None):
    """Best cut of integer features by trying all, to a depth."""
    out = {} if out is None else out
    out[node] = (len(y), y.mean())
    if ht.level(node) < depth:
        cuts = [(sse(y) - sse(y[x[:, j] <= c]) - sse(y[x[:, j] > c]), -j, -c) for j in range(x.shape[1])
                for c in np.unique(x[:, j])[:-1]]
        if cuts and max(cuts)[0] > 1e-9:
            _, j, c = max((round(g, 9), a, b) for g, a, b in cuts)
            left = x[:, -j] <= -c
            plain(x[left], y[left], depth, 2 * node + 1, out)
            plain(x[~left], y[~left], depth, 2 * node + 2, out)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_to_plain_search(spark, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 8, (300, 3))
    x[0], x[1] = 0, 7
    y = np.round(x[:, 0] * 2.0 + (x[:, 1] > 3) * 5 - x[:, 2] * (x[:, 0] > 2) + rng.integers(0, 3, 300))
    df = table(spark, x, y)
    tree = ht.grow(df, depth=3, bins=7)   # eight values: bin i holds i, the last one 7 too
    binned = np.minimum(x, 6)
    want = plain(binned, y, 3)
    assert {i: (int(n.n), round(n.mean, 9)) for i, n in tree.nodes.items()} == {i: (n, round(m, 9)) for i, (n, m) in want.items()}
    for depth in (1, 2):   # a shallower tree is the top of a deeper one
        small = ht.grow(df, depth=depth, bins=7)
        cut = tree.at_depth(depth)
        assert {i: (n.n, n.feature) for i, n in small.nodes.items()} == {i: (n.n, n.feature) for i, n in cut.nodes.items()}
        a = [r["prediction"] for r in tree.predict(df, depth=depth).orderBy("features", "label").collect()]
        b = [r["prediction"] for r in small.predict(df).orderBy("features", "label").collect()]
        assert a == b


def test_categories_by_all_bipartitions(spark):
    rng = np.random.default_rng(4)
    c = rng.integers(0, 6, 200)
    y = np.array([3, 0, 5, 1, 4, 2])[c] + rng.integers(0, 2, 200) * 1.0
    tree = ht.grow(table(spark, c[:, None], y), depth=1, categories={0: 6})
    best = min(sse(y[np.isin(c, s)]) + sse(y[~np.isin(c, s)]) for n in range(1, 6) for s in itertools.combinations(range(6), n))
    left = np.flatnonzero(tree.nodes[0].left[:6])
    assert sse(y[np.isin(c, left)]) + sse(y[~np.isin(c, left)]) == pytest.approx(best)
    unseen = tree.predict(table(spark, [[9], [-1], [2.5]], [0, 0, 0])).collect()
    assert {r["prediction"] for r in unseen} == {tree.nodes[2].mean}


@pytest.mark.parametrize("impurity", ["gini", "entropy"])
def test_classes_equal_library(spark, impurity):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(5)
    x = rng.integers(0, 4, (400, 3))
    y = ((x[:, 0] + x[:, 1] > 3) ^ (rng.random(400) < 0.1)).astype(float)
    df = table(spark, x, y)
    tree = ht.grow(df, depth=2, bins=4, impurity=impurity)
    lib = DecisionTreeClassifier(maxDepth=2, impurity=impurity).fit(df.withColumn("features", array_to_vector("features")))
    ours = tree.predict(df).collect()
    theirs = lib.transform(df.withColumn("raw", df.features).withColumn("features", array_to_vector("features"))).collect()
    # the library joins leaves of one predicted class, so classes are compared
    ours = sorted((tuple(r["features"]), float(r["prediction"] > 0.5)) for r in ours)
    theirs = sorted((tuple(r["raw"]), r["prediction"]) for r in theirs)
    assert ours == theirs


def test_edges(spark):
    x, y = [[1, 5], [2, None], [3, 5], None and [], [4, 5]], [1, 2, None, 3, 3]
    rows = [(None if r is None else [None if v is None else float(v) for v in r], None if t is None else float(t)) for r, t in zip(x, y)]
    df = spark.createDataFrame(rows, "features array<double>, label double").coalesce(1)
    tree = ht.grow(df, depth=4)
    assert {i: int(n.n) for i, n in tree.nodes.items()} == {0: 2, 1: 1, 2: 1}   # the constant feature is never cut
    assert [r["prediction"] for r in tree.predict(df).collect()] == [1.0, None, 3.0, None, 3.0]
    assert ht.grow(df.filter("false")).nodes == {}
    assert list(ht.grow(df, depth=4, min_rows=2).nodes) == [0]
    with pytest.raises(ValueError):
        ht.grow(df, impurity="other")
