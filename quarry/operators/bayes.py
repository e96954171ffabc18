"""Multinomial naive Bayes in closed form over a long feature table.

theta[c, j] = ln((S[c, j] + s) / (T[c] + s * V)),  prior[c] = ln((n_c + s) / (n + s * C))

where S is the per-class feature sum, T the class total, V the number of
features and C the number of classes (the prior is smoothed too, as in
``pyspark.ml.classification.NaiveBayes``). Only (class, feature) pairs that
occur are materialised; an unseen pair's theta is the class constant
ln(s / (T[c] + s V)), so a document's score is

    prior[c] + X * ln(s / (T[c] + s V)) + sum_j x_j * ln((S[c, j] + s) / s)

with X the document's feature total. The class table (C rows) is the only
thing brought to the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class NaiveBayesModel:
    classes: list[float]
    prior: list[float]
    log_denominator: list[float]
    sums: DataFrame          # (label, j, S)
    smoothing: float
    num_features: int


def fit(docs: DataFrame, long: DataFrame, num_features: int, smoothing: float = 1.0,
        doc: str = "doc_id", label: str = "label") -> NaiveBayesModel:
    """``docs`` is (doc, label); ``long`` is (doc, j, x) with x >= 0."""
    return fit_many(docs, long, num_features, [smoothing], doc, label)[0]


def fit_many(docs: DataFrame, long: DataFrame, num_features: int, smoothings: list[float],
             doc: str = "doc_id", label: str = "label") -> list[NaiveBayesModel]:
    """A model for each smoothing; all share the same sums, taken once."""
    from ..sources.files import materialise
    n_c = docs.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    # the per-class feature sums are the model: written once, then read by
    # the class totals here and by every later prediction
    sums = materialise(long.join(docs.select(doc, label), doc)
                       .groupBy(F.col(label).cast("double").alias(label), "j").agg(F.sum("x").alias("S")), "nb-sums")
    totals = sums.groupBy(label).agg(F.sum("S").alias("T"))
    cls = n_c.join(totals, label, "left").orderBy(label).collect()   # C rows: model-sized
    n = sum(r["n_c"] for r in cls)
    C = len(cls)
    classes = [float(r[label]) for r in cls]
    out = []
    for s in map(float, smoothings):
        prior = [math.log((r["n_c"] + s) / (n + s * C)) for r in cls]
        logden = [math.log((r["T"] or 0.0) + s * num_features) for r in cls]
        out.append(NaiveBayesModel(classes, prior, logden, sums, s, num_features))
    return out


def predict(model: NaiveBayesModel, docs: DataFrame, long: DataFrame, doc: str = "doc_id",
            label: str = "label") -> DataFrame:
    """(doc, prediction): argmax over classes, ties to the smaller class."""
    return predict_many([model], docs, long, doc, label).withColumnRenamed("p0", "prediction")


def predict_many(models: list[NaiveBayesModel], docs: DataFrame, long: DataFrame, doc: str = "doc_id",
                 label: str = "label") -> DataFrame:
    """(doc, p0, p1, ...): the prediction of each of the models of one
    ``fit_many``; the features are joined and summed once for all of them."""
    lifts = F.array(*[F.log((F.col("S") + m.smoothing) / m.smoothing) for m in models])
    sums = models[0].sums.select(label, "j", lifts.alias("lift"))
    extra = (long.join(sums, "j")
             .groupBy(doc, label).agg(*[F.sum(F.col("x") * F.col("lift")[k]).alias(f"e{k}") for k in range(len(models))])
             .groupBy(doc).agg(F.map_from_entries(F.collect_list(F.struct(
                 label, F.array(*[f"e{k}" for k in range(len(models))])))).alias("_extra")))
    tot = long.groupBy(doc).agg(F.sum("x").alias("_X"))
    d = (docs.select(doc).join(tot, doc, "left").join(extra, doc, "left")
         .select(doc, F.coalesce("_X", F.lit(0.0)).alias("_X"), "_extra"))
    out = []
    for k, model in enumerate(models):
        ln_s = math.log(model.smoothing)
        best = None
        for c, p, ld in zip(model.classes, model.prior, model.log_denominator):
            sc = (F.lit(p) + F.col("_X") * F.lit(ln_s - ld)
                  + F.coalesce(F.element_at(F.col("_extra"), F.lit(c))[k], F.lit(0.0)))
            cand = F.struct(sc.alias("score"), F.lit(-c).alias("neg"))
            best = cand if best is None else F.greatest(best, cand)
        out.append((-best.getField("neg")).alias(f"p{k}"))
    return d.select(doc, *out)
