"""Model metrics as aggregates: regression errors, accuracy, binary curve
areas, weighted F-measure, and ranking precision."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .indexing import running_totals


def regression_metrics(df: DataFrame, pred: str = "prediction", label: str = "label") -> DataFrame:
    """MSE, RMSE, MAE and RMSLE in one aggregate.

    RMSLE uses ``log1p(max(prediction, 0))``: a negative prediction would make
    the logarithm undefined, so it is clamped at zero.
    """
    d = F.col(pred) - F.col(label)
    sle = F.pow(F.log1p(F.greatest(F.col(pred), F.lit(0.0))) - F.log1p(F.col(label)), 2)
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(d * d).alias("mse"),
        F.sqrt(F.avg(d * d)).alias("rmse"),
        F.avg(F.abs(d)).alias("mae"),
        F.sqrt(F.avg(sle)).alias("rmsle"))


def accuracy(df: DataFrame, pred: str = "prediction", label: str = "label") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.sum((F.col(pred) == F.col(label)).cast("long")).alias("n_correct"),
                  F.avg((F.col(pred) == F.col(label)).cast("double")).alias("accuracy"))


def binary_areas(df: DataFrame, score: str, label: str) -> DataFrame:
    """Areas under the ROC and precision-recall curves, as the curve-based
    binary metrics: thresholds are the distinct scores in descending order;
    ROC runs (0,0) .. (1,1); PR starts at (0, precision of the first
    threshold). Trapezoids between consecutive points.

    Counts per distinct score are one aggregate; cumulative counts use range
    partitions with per-partition offsets (not a one-task window). The
    previous point of every threshold is its cumulative count minus its own
    count, so each trapezoid is a row-local expression and the areas are one
    final aggregate. The lowest threshold holds every row, so the curve ends
    at (1, 1) by itself.
    """
    from .common import attach_row
    pos = (F.col(label) > 0.5).cast("long")
    per = df.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.sum(pos).alias("tp"), F.sum(1 - pos).alias("fp"))
    cum = running_totals(per.withColumn("neg_s", -F.col("s")), "neg_s", ["tp", "fp"])
    tot = per.agg(F.sum("tp").alias("P"), F.sum("fp").alias("N"))
    c = attach_row(cum, tot)
    ctp, cfp = F.col("cum_tp"), F.col("cum_fp")
    ptp, pfp = ctp - F.col("tp"), cfp - F.col("fp")
    # with one class only, the rates of the other one and the areas that need them are null
    fpr, tpr = F.try_divide(cfp, F.col("N")), F.try_divide(ctp, F.col("P"))
    pfpr, ptpr = F.try_divide(pfp, F.col("N")), F.try_divide(ptp, F.col("P"))
    prec = F.try_divide(ctp, ctp + cfp)
    pprec = F.coalesce(F.try_divide(ptp, ptp + pfp), prec)
    roc = (fpr - pfpr) * (tpr + ptpr) / 2
    pr = (tpr - ptpr) * (prec + pprec) / 2
    return c.agg(F.sum(roc).alias("area_under_roc"), F.sum(pr).alias("area_under_pr"))


def weighted_f_measure(df: DataFrame, pred: str = "prediction", label: str = "label") -> DataFrame:
    """Label-frequency-weighted F1, precision and recall from the confusion
    counts (group-bys over (label, prediction); nothing per row is kept)."""
    conf = df.groupBy(F.col(label).alias("l"), F.col(pred).alias("p")).agg(F.count(F.lit(1)).alias("c"))
    tp = conf.filter(F.col("l") == F.col("p")).select(F.col("l").alias("k"), F.col("c").alias("tp"))
    actual = conf.groupBy(F.col("l").alias("k")).agg(F.sum("c").alias("n_actual"))
    predicted = conf.groupBy(F.col("p").alias("k")).agg(F.sum("c").alias("n_pred"))
    per = (actual.join(predicted, "k", "left").join(tp, "k", "left")
           .select("k", "n_actual", F.coalesce("n_pred", F.lit(0)).alias("n_pred"),
                   F.coalesce("tp", F.lit(0)).alias("tp")))
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(F.lit(0.0))
    rec = F.col("tp") / F.col("n_actual")
    per = per.select("n_actual", prec.alias("prec"), rec.alias("rec"))
    f1 = F.when(F.col("prec") + F.col("rec") > 0,
                2 * F.col("prec") * F.col("rec") / (F.col("prec") + F.col("rec"))).otherwise(F.lit(0.0))
    return per.agg(
        (F.sum(f1 * F.col("n_actual")) / F.sum("n_actual")).alias("weighted_f_measure"),
        (F.sum(F.col("prec") * F.col("n_actual")) / F.sum("n_actual")).alias("weighted_precision"),
        (F.sum(F.col("rec") * F.col("n_actual")) / F.sum("n_actual")).alias("weighted_recall"))


def average_precision(truth: DataFrame, ranked: DataFrame, user: str, item: str, rank: str,
                      k: int | None, users: DataFrame | None = None) -> DataFrame:
    """Per-user average precision of a ranked list against the truth set.

    ``ranked`` is (user, item, rank) with rank starting at 1; ``truth`` is
    (user, item). Hits are truth rows whose item has rank <= k; the j-th hit
    at rank r adds j / r; the sum is divided by min(|truth|, k). Users with
    truth but no hits score 0. Only truth rows are touched, never the full
    users x items list. ``k=None`` means the whole list. With ``users`` (a
    column ``user``) there is a row for each of them too: one without truth scores 1.0.
    """
    from .indexing import rank_within_group
    # a ranked list is either per user (user, item, rank) or global (item, rank)
    hits = truth.join(ranked, [c for c in (user, item) if c in ranked.columns])
    if k is not None:
        hits = hits.filter(F.col(rank) <= k)
    hits = rank_within_group(hits, user, rank, "_j")
    score = hits.groupBy(user).agg(F.sum(F.col("_j") / F.col(rank)).alias("_s"))
    sizes = truth.groupBy(user).agg(F.count(F.lit(1)).alias("_n"))
    denom = F.col("_n") if k is None else F.least(F.col("_n"), F.lit(k))
    known = (sizes.join(score, user, "left")
             .select(user, (F.coalesce(F.col("_s"), F.lit(0.0)) / denom).alias("ap")))
    if users is None:
        return known
    return users.select(user).distinct().join(known, user, "full").select(user, F.coalesce("ap", F.lit(1.0)).alias("ap"))


def hard_label_roc_many(df: DataFrame, pred_cols: list[str], label: str = "label") -> list[float]:
    """Area under ROC of several hard (0/1) predictions of the same rows in
    one aggregate: with two thresholds the curve is (0,0), (FPR, TPR), (1,1),
    whose area is (TPR + TNR) / 2. Equal to ``binary_areas`` on each column."""
    pos = F.col(label) > 0.5
    aggs = [F.sum(pos.cast("long")).alias("_P"), F.sum((~pos).cast("long")).alias("_N")]
    for c in pred_cols:
        hit = F.col(c) > 0.5
        aggs += [F.sum((hit & pos).cast("long")).alias(f"{c}__tp"), F.sum((~hit & ~pos).cast("long")).alias(f"{c}__tn")]
    r = df.agg(*aggs).first()
    out = []
    for c in pred_cols:
        tpr = r[f"{c}__tp"] / r["_P"] if r["_P"] else 0.0
        tnr = r[f"{c}__tn"] / r["_N"] if r["_N"] else 0.0
        out.append((tpr + tnr) / 2)
    return out


def hard_label_summary(df: DataFrame, pred: str = "prediction", label: str = "label") -> dict:
    """Accuracy and the ROC / PR areas of a hard (0/1) prediction from one
    aggregate of confusion counts. With thresholds {1, 0} the ROC curve is
    (0,0), (FPR, TPR), (1,1) and the PR curve (0, p1), (TPR, p1),
    (1, P / (P + N)); equal to ``binary_areas`` on the same column."""
    pos, hit = F.col(label) > 0.5, F.col(pred) > 0.5
    r = df.agg(F.sum((hit & pos).cast("long")).alias("tp"), F.sum((hit & ~pos).cast("long")).alias("fp"),
               F.sum((~hit & ~pos).cast("long")).alias("tn"), F.sum((~hit & pos).cast("long")).alias("fn")).first()
    tp, fp, tn, fn = (r[k] or 0 for k in ("tp", "fp", "tn", "fn"))
    P, N = tp + fn, fp + tn
    n = P + N
    tpr = tp / P if P else 0.0
    fpr = fp / N if N else 0.0
    base = P / n if n else 0.0
    if tp + fp > 0:
        p1 = tp / (tp + fp)
        pr = tpr * p1 + (1.0 - tpr) * (p1 + base) / 2
    else:   # only the threshold 0: the curve starts at (0, base) and ends at (1, base)
        pr = base
    roc = fpr * tpr / 2 + (1.0 - fpr) * (tpr + 1.0) / 2
    return {"accuracy": (tp + tn) / n if n else 0.0, "area_under_roc": roc, "area_under_pr": pr}
