"""Joint naive Bayes and the packed Gramian against plain versions."""

import numpy as np
from pyspark.sql import functions as F

from quarry.operators import bayes, decompose
from quarry.plans import study_plans
from quarry.sources import Tables
from conftest import SF_SMALL


def test_joint_smoothings_equal_separate_fits(spark):
    docs = spark.createDataFrame([(i, float(i % 3 == 0)) for i in range(30)], "doc_id int, label double")
    long = spark.createDataFrame([(i, (i * j) % 7, float(1 + i % 2)) for i in range(29) for j in (1, 2)],
                                 "doc_id int, j int, x double")
    values = [0.01, 1.0, 10.0]
    joint = bayes.predict_many(bayes.fit_many(docs, long, 7, values), docs, long).orderBy("doc_id").collect()
    assert len(joint) == 30   # a document without features too
    for k, v in enumerate(values):
        one = bayes.predict(bayes.fit(docs, long, 7, v), docs, long).orderBy("doc_id").collect()
        assert [r[f"p{k}"] for r in joint] == [r["prediction"] for r in one]


def test_packed_gramian_over_uneven_partitions(spark):
    x = np.random.default_rng(1).normal(size=(40, 9))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id int, v array<double>")
    df = df.repartition(13, F.col("id") % 5)   # some partitions stay empty
    c = x - x.mean(0)
    assert np.allclose(decompose.gramian_matrix(decompose.gramian_rows(df, "v")), c.T @ c)
    assert np.allclose(decompose.gramian_matrix(decompose.gramian_rows(df, "v", centre=False)), x.T @ x)
    assert decompose.gramian(df.limit(0), "v").count() == 0


def test_category_features_of_a_null_category(spark):
    class Pages:
        def page_classification(self, materialised=False):
            rows = [(1, 1.0, "a", [1.0, 2.0]), (2, 0.0, None, [3.0, 2.0]), (3, 0.0, "b", [5.0, 2.0])]
            return spark.createDataFrame(rows, "doc_id int, label double, category string, features array<double>")
    got = {r["doc_id"]: r["features"] for r in study_plans._category_features(Pages()).collect()}
    assert got == {1: [1, 0, -1, 0], 2: [0, 0, 0, 0], 3: [0, 1, 1, 0]}


def test_category_features_keep_every_page(spark):
    t = Tables(spark, SF_SMALL)
    assert study_plans._category_features(t).count() == t.page_classification().count()
