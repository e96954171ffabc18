"""Seeded / library-model plans: tree sweeps, hashed TF-IDF naive Bayes,
word vectors. Checked by invariants in the tests; rows-only here."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import encode, metrics, trees, tune
from ..operators.common import attach_row
from ..sources import Tables
from ..sources.files import materialise
from .catalog import register
from .text_plans import _pruned_tf

DEPTHS = (1, 2, 3, 4, 5, 10, 20)   # fixed values: swept tree depths
BINS = (2, 4, 8, 16, 32, 64, 100)   # fixed values: swept bin counts
ARITIES = {0: 24, 1: 7}              # declared codes: hour of day, day of week; the day of month is continuous


@register("tree_classifier_sweep")
def tree_classifier_sweep(spark, sf_dir):
    pc = Tables(spark, sf_dir).page_classification(materialised=True).select("doc_id", "features", "label").persist()
    rows = []
    for impurity in ("entropy", "gini"):
        for depth in DEPTHS:
            model, data = trees.fit_classifier(pc, "features", "label", impurity, depth)
            pred = model.transform(data).select("prediction", "label")
            a = metrics.hard_label_summary(pred)     # one aggregate per tree
            info = trees.introspect(model)
            rows.append((impurity, depth, float(a["accuracy"]), float(a["area_under_roc"]),
                         float(a["area_under_pr"]), info["depth"], info["num_nodes"]))
    pc.unpersist()
    return spark.createDataFrame(rows, "impurity string, max_depth int, accuracy double, area_under_roc double, "
                                       "area_under_pr double, depth int, num_nodes int")


@register("tree_regressor_sweep")
def tree_regressor_sweep(spark, sf_dir):
    """Depth and bins of regression trees on hourly demand, all features
    continuous, and one tree with declared arities; RMSLE on a 70/30 keyed hold-out."""
    hd = Tables(spark, sf_dir).hourly_demand().withColumn(
        "_key", F.unix_timestamp(F.col("hour_start").cast("timestamp")))
    raw = hd.select(F.array(F.col("hr").cast("double"), F.col("weekday").cast("double"),
                            F.col("day").cast("double")).alias("features"), F.col("cnt").alias("label"), "_key")
    raw = raw.persist()
    train, test = tune.hash_split(raw, "_key", 0.3)
    settings = [("max_depth", d, dict(max_depth=d)) for d in DEPTHS]
    settings += [("max_bins", b, dict(max_depth=5, max_bins=b)) for b in BINS]
    settings += [("declared_arities", len(ARITIES), dict(max_depth=5, arities=ARITIES, width=3))]
    rows = []
    for param, v, how in settings:
        model, data = trees.fit_regressor(train, "features", "label", **how)
        held = trees.vectors(test, "features", how.get("arities"), how.get("width"))
        tr, te = (metrics.regression_metrics(model.transform(d).select("prediction", "label")).first()
                  for d in (data, held))
        info = trees.introspect(model)
        rows.append((param, v, tr["rmsle"], te["rmsle"], tr["mse"], te["mse"], info["depth"], info["num_nodes"]))
    raw.unpersist()
    return spark.createDataFrame(rows, "param string, value int, train_rmsle double, test_rmsle double, "
                                       "train_mse double, test_mse double, depth int, num_nodes int")


@register("hashing_tfidf_nb")
def hashing_tfidf_nb(spark, sf_dir):
    """Tokens without rare ones (corpus count below 2) -> 2^18 hashed term frequencies -> IDF -> multinomial naive Bayes
    (smoothing 0.1) predicting the language; hold-out by keyed hash."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import IDF, HashingTF
    d = Tables(spark, sf_dir).documents
    lab = encode.category_index(d, "lang", "label")
    # a term as often as the text holds it; texts without a kept term stay, with none
    kept = (_pruned_tf(d).groupBy("doc_id")
            .agg(F.flatten(F.collect_list(F.array_repeat("term", F.col("tf").cast("int")))).alias("tokens")))
    # written once: IDF, naive Bayes and the predictions each pass over the token lists
    docs = materialise(d.select("doc_id", "lang").join(lab, "lang").join(kept, "doc_id", "left")
                       .select("doc_id", F.col("label").cast("double").alias("label"),
                               F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens")), "doc-tokens")
    train, test = tune.hash_split(docs, "doc_id", 0.2)
    pipe = Pipeline(stages=[HashingTF(numFeatures=1 << 18, inputCol="tokens", outputCol="tf"),
                            IDF(inputCol="tf", outputCol="tfidf"),
                            NaiveBayes(featuresCol="tfidf", labelCol="label", smoothing=0.1)])
    model = pipe.fit(train)
    pred = materialise(model.transform(test).select("prediction", "label"), "hashed-predictions")
    return attach_row(metrics.accuracy(pred), metrics.weighted_f_measure(pred))


@register("word2vec_synonyms")
def word2vec_synonyms(spark, sf_dir):
    """Word vectors over the normalised tokens; the 20 nearest words of the
    most frequent token (cosine on the learned vectors)."""
    from pyspark.ml.feature import Word2Vec
    d = Tables(spark, sf_dir).documents
    # tokenised once: the fit passes over the token lists twice, the most frequent word once
    toks = materialise(d.select(T.normalised_tokens(F.col("text")).alias("tokens")), "token-lists")
    model = Word2Vec(vectorSize=100, maxIter=1, seed=42, minCount=5, inputCol="tokens", outputCol="_v",
                     numPartitions=spark.sparkContext.defaultParallelism).fit(toks)
    top = (toks.select(F.explode("tokens").alias("w")).groupBy("w").count()
           .orderBy(F.desc("count"), "w").first()["w"])
    return model.findSynonyms(top, 20).select(F.lit(top).alias("query"), "word", "similarity")
