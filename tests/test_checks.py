"""Median, declared arities and ranking of the fitted model on small rows."""

import statistics

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from quarry.operators import metrics, profile, trees


def test_median_of_even_odd_and_no_values(spark):
    for values in ([5.0, 1.0, 9.0], [4.0, 1.0, 2.0, 8.0], [7.0, 7.0], []):
        rows = [(i, v) for i, v in enumerate(values)] + [(100, -1.0), (101, None)]
        df = spark.createDataFrame(rows, "k long, v double")
        got = {r["k"]: r["o"] for r in profile.impute_median(df, "k", "v", F.col("v") < 0, "o").collect()}
        assert got[100] == (statistics.median(values) if values else None)
        assert got[101] is None and all(got[i] == v for i, v in enumerate(values))


def test_arities_are_declared_not_counted(spark):
    rows = [([float(c), float(x)], float(c in (1, 3)) + 0.01 * x) for c in range(4) for x in range(4)]
    df = spark.createDataFrame(rows, "features array<double>, label double")
    model, _ = trees.fit_regressor(df, "features", "label", 1, arities={0: 4}, width=2)
    assert "in {" in model.toDebugString
    plain, _ = trees.fit_regressor(df, "features", "label", 1)
    assert "in {" not in plain.toDebugString


def test_ranking_of_the_model_lists(spark):
    truth = {1: {10, 11}, 2: {12}, 3: {13}}
    lists = {1: [11, 99, 10], 2: [98, 12], 3: [97]}
    t = spark.createDataFrame([(u, i) for u, s in truth.items() for i in s], "user long, item long")
    r = spark.createDataFrame([(u, i, k + 1) for u, l in lists.items() for k, i in enumerate(l)],
                              "user long, item long, rank int")
    got = {x["user"]: x["ap"] for x in metrics.average_precision(t, r, "user", "item", "rank", 3).collect()}
    assert {u: round(a, 9) for u, a in got.items()} == {1: round((1 + 2 / 3) / 2, 9), 2: 0.5, 3: 0.0}
    row = E.queries()["als_ranking"](spark, SF_SMALL).first()
    assert 0 <= row["map"] <= row["mapk"] <= 1
