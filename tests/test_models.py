"""Invariants for the models: library cross-checks and the reference's own
self-checks (manual metric = library metric, closed form = fitted model)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.operators import bayes, encode, linear, metrics, recommend
from quarry.sources import Tables


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SF_SMALL)


def _mllib_points(df):
    from pyspark.mllib.regression import LabeledPoint
    return df.select("features", "label").rdd.map(lambda r: LabeledPoint(r.label, list(r.features)))


@pytest.mark.parametrize("loss,reg,lam,intercept,step", [
    ("logistic", "none", 0.0, False, 1.0),
    ("hinge", "l2", 0.01, False, 1.0),
    ("squared", "l1", 0.1, False, 0.1),
    ("squared", "l2", 0.1, True, 0.1),
])
def test_gd_fit_matches_mllib_sgd(spark, t, loss, reg, lam, intercept, step):
    from pyspark.mllib.classification import LogisticRegressionWithSGD, SVMWithSGD
    from pyspark.mllib.regression import LinearRegressionWithSGD
    data = t.page_classification() if loss != "squared" else t.hourly_demand().withColumnRenamed("cnt", "label")
    ours = linear.gd_fit(data, loss=loss, step=step, iters=3, reg=reg, reg_param=lam, intercept=intercept)
    pts = _mllib_points(data)
    kw = dict(iterations=3, step=step, miniBatchFraction=1.0, regParam=lam,
              regType=None if reg == "none" else reg, intercept=intercept, convergenceTol=0.0)
    lib = {"logistic": LogisticRegressionWithSGD, "hinge": SVMWithSGD, "squared": LinearRegressionWithSGD}[loss]
    m = lib.train(pts, **kw)
    want = list(m.weights.toArray()) + ([m.intercept] if intercept else [])
    assert np.allclose(ours.weights, want, rtol=1e-9, atol=1e-12)


def test_gd_wide_path_equals_narrow(spark):
    rows = [(float(i % 2), [float((i * j) % 7) / 7 for j in range(70)]) for i in range(60)]
    df = spark.createDataFrame(rows, "label double, features array<double>")
    wide = linear.gd_fit(df, loss="logistic", iters=2)
    narrow = linear.gd_fit(df.select("label", F.slice("features", 1, 70).alias("features")), loss="logistic",
                           iters=2)
    assert np.allclose(wide.weights, narrow.weights)
    # one path at any width: the same weights as plain gradient descent
    y, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    w = np.zeros(70)
    for i in (1, 2):
        w -= x.T @ (1 / (1 + np.exp(-x @ w)) - y) / len(y) / np.sqrt(i)
    assert np.allclose(wide.weights, w)


def test_naive_bayes_closed_form_matches_ml(spark, t):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.functions import array_to_vector
    pc = t.page_classification()
    idx = encode.category_index(pc, "category")
    k = idx.count()
    rows = pc.join(idx, "category")
    docs = rows.select("doc_id", "label")
    long = rows.select("doc_id", F.col("category_index").alias("j"), F.lit(1.0).alias("x"))
    model = bayes.fit(docs, long, k, 1.0)
    ours = {r.doc_id: r.prediction for r in bayes.predict(model, docs, long).collect()}
    vec = rows.select("doc_id", "label", array_to_vector(encode.one_hot_array(F.col("category_index").cast("int"),
                                                                              F.lit(k))).alias("fv"))
    ml = NaiveBayes(smoothing=1.0, featuresCol="fv", labelCol="label").fit(vec)
    theirs = {r.doc_id: r.prediction for r in ml.transform(vec).select("doc_id", "prediction").collect()}
    assert ours == theirs
    assert np.allclose(model.prior, ml.pi.toArray())


def test_standardise_equals_library_scaler(spark, t):
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array
    e = t.embeddings
    ours = encode.standardise(e, "embedding", "z").select("vec_id", "z")
    v = e.withColumn("fv", array_to_vector(F.transform("embedding", lambda x: x.cast("double"))))
    sc = StandardScaler(withMean=True, withStd=True, inputCol="fv", outputCol="s").fit(v)
    lib = sc.transform(v).select("vec_id", vector_to_array("s").alias("s"))
    a = {r.vec_id: r.z for r in ours.collect()}
    b = {r.vec_id: r.s for r in lib.collect()}
    assert all(np.allclose(a[k], b[k], atol=1e-9) for k in a)


def test_normalised_rows_have_unit_norm(spark, t):
    u = encode.l2_normalise(t.embeddings, "embedding", "u")
    norms = [float(np.linalg.norm(r.u)) for r in u.select("u").collect()]
    assert np.allclose(norms, 1.0)


def test_binary_areas_match_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rows = [(float((i * 37) % 11) / 11.0, float((i * 13 + i // 3) % 2)) for i in range(300)]
    df = spark.createDataFrame(rows, "score double, label double")
    a = metrics.binary_areas(df, "score", "label").first()
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label")
    assert abs(a.area_under_roc - ev.setMetricName("areaUnderROC").evaluate(df)) < 1e-9
    assert abs(a.area_under_pr - ev.setMetricName("areaUnderPR").evaluate(df)) < 1e-9


def test_hard_label_roc_is_mean_of_tpr_tnr(spark):
    rows = [(float(i % 3 == 0), float(i % 2 == 0)) for i in range(120)]
    df = spark.createDataFrame(rows, "p double, label double")
    a = metrics.binary_areas(df, "p", "label").first()
    pdf = df.toPandas()
    tpr = ((pdf.p == 1) & (pdf.label == 1)).sum() / (pdf.label == 1).sum()
    tnr = ((pdf.p == 0) & (pdf.label == 0)).sum() / (pdf.label == 0).sum()
    assert abs(a.area_under_roc - (tpr + tnr) / 2) < 1e-12


def test_weighted_f_matches_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rows = [(float(i % 4), float((i * 7) % 4 if i % 3 else i % 4)) for i in range(200)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    ours = metrics.weighted_f_measure(df).first()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    assert abs(ours.weighted_f_measure - ev.setMetricName("weightedFMeasure").evaluate(df)) < 1e-12
    assert abs(ours.weighted_precision - ev.setMetricName("weightedPrecision").evaluate(df)) < 1e-12
    assert abs(ours.weighted_recall - ev.setMetricName("weightedRecall").evaluate(df)) < 1e-12


def test_map_matches_ranking_evaluator(spark, t):
    from pyspark.ml.evaluation import RankingEvaluator
    r = t.ratings()
    ranked = recommend.popularity_ranking(r)
    ap = metrics.average_precision(r.select("user", "item"), ranked, "user", "item", "rank", None)
    ours = ap.agg(F.avg("ap")).first()[0]
    order = [float(x.item) for x in ranked.orderBy("rank").collect()]
    truth = r.groupBy("user").agg(F.collect_list(F.col("item").cast("double")).alias("label"))
    pl = truth.withColumn("prediction", F.array(*[F.lit(v) for v in order]))
    lib = RankingEvaluator(metricName="meanAveragePrecision").evaluate(pl)
    assert abs(ours - lib) < 1e-9
    ap10 = metrics.average_precision(r.select("user", "item"), ranked, "user", "item", "rank", 10)
    lib10 = RankingEvaluator(metricName="meanAveragePrecisionAtK", k=10).evaluate(pl)
    assert abs(ap10.agg(F.avg("ap")).first()[0] - lib10) < 1e-9


def test_als_manual_mse_equals_evaluator(spark, t):
    from pyspark.ml.evaluation import RegressionEvaluator
    model, data = recommend.fit_als(t.ratings(), rank=5, max_iter=3)
    scored = model.transform(data).select(F.col("prediction").cast("double"), F.col("rating").cast("double").alias("label"))
    ours = metrics.regression_metrics(scored).first().mse
    lib = RegressionEvaluator(metricName="mse", predictionCol="prediction", labelCol="label").evaluate(scored)
    assert abs(ours - lib) < 1e-9


def test_item_self_similarity_is_one(spark, t):
    from quarry.functions import vectors as V
    e = t.embeddings
    s = e.select(V.cosine(V.as_doubles(F.col("embedding")), V.as_doubles(F.col("embedding"))).alias("c"))
    assert np.allclose([r.c for r in s.collect()], 1.0)


def test_pca_and_svd_agree_up_to_sign(spark):
    import __spark_entry__ as E
    df = E.queries()["pca_projection"](spark, SF_SMALL)
    assert df.agg(F.bool_and("agrees")).first()[0] is True


def test_svd_spectrum_matches_numpy(spark, t):
    import __spark_entry__ as E
    got = [r.singular_value for r in E.queries()["svd_spectrum"](spark, SF_SMALL).orderBy("component").collect()]
    x = np.array([r.embedding for r in t.embeddings.collect()], dtype=np.float64)
    s = np.linalg.svd(x - x.mean(axis=0), compute_uv=False)
    assert np.allclose(got, s, rtol=1e-8, atol=1e-8)


def test_tokenizer_staged_equals_composed(spark, t):
    from quarry.functions import text as T
    d = t.documents
    composed = d.select(F.explode(T.normalised_tokens(F.col("text"))).alias("t"))
    staged = (d.select(F.explode(T.nonword_tokens(F.col("text"))).alias("t"))
              .filter(F.col("t").rlike(T.NO_DIGITS))
              .filter(~F.col("t").isin(*T.STOPWORDS))
              .filter(F.length("t") >= T.MIN_TOKEN_LENGTH))
    assert composed.count() == staged.count()
    assert composed.distinct().count() == staged.distinct().count()


def test_joint_fit_equals_separate_fits(spark, t):
    data = t.hourly_demand().withColumnRenamed("cnt", "label")
    cfgs = [dict(loss="squared", step=0.1, iters=3, reg="l1", reg_param=0.1),
            dict(loss="squared", step=0.05, iters=5, reg="l2", reg_param=0.01, intercept=True),
            dict(loss="squared", step=0.1, iters=1)]
    joint = linear.gd_fit_many(data, cfgs)
    for c, m in zip(cfgs, joint):
        assert np.allclose(m.weights, linear.gd_fit(data, **c).weights, rtol=1e-12, atol=1e-14)


def test_hard_label_roc_many_equals_curve_area(spark):
    rows = [(float(i % 2 == 0), float(i % 3 == 0), float(i % 5 < 2)) for i in range(150)]
    df = spark.createDataFrame(rows, "label double, a double, b double")
    many = metrics.hard_label_roc_many(df, ["a", "b"])
    for c, v in zip(["a", "b"], many):
        assert abs(metrics.binary_areas(df, c, "label").first().area_under_roc - v) < 1e-12


def test_hard_label_summary_equals_curve_areas(spark):
    for mod in (3, 7, 1000):
        rows = [(float(i % 2 == 0), float(i % mod == 0)) for i in range(140)]
        df = spark.createDataFrame(rows, "label double, prediction double")
        got = metrics.hard_label_summary(df)
        want = metrics.binary_areas(df, "prediction", "label").first()
        assert abs(got["area_under_roc"] - want.area_under_roc) < 1e-12
        assert abs(got["area_under_pr"] - want.area_under_pr) < 1e-12
        assert abs(got["accuracy"] - metrics.accuracy(df).first().accuracy) < 1e-12
