"""Classification and regression plans: features, gradient descent,
naive Bayes, curve metrics, splits and target transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.parsing import missing_to_zero, strip_quotes
from ..operators import bayes, encode, linear, metrics, textops, tune  # noqa: F401
from ..operators.common import attach_row
from ..sources import Tables
from . import model_sql as S
from .catalog import register
from .text_plans import _pruned_tf

# Gradient-descent settings of the four linear queries.
GD = {
    "logistic_gd": dict(loss="logistic", step=1.0, iters=10, reg="none", reg_param=0.0, intercept=False),
    "svm_gd": dict(loss="hinge", step=1.0, iters=10, reg="l2", reg_param=0.01, intercept=False),
    "linear_gd_l1": dict(loss="squared", step=0.1, iters=10, reg="l1", reg_param=1.0, intercept=False),
    "linear_gd_l2": dict(loss="squared", step=0.1, iters=10, reg="l2", reg_param=1.0, intercept=True),
}


@register("page_features", r"""
SELECT l.doc_id, CAST(l.quality AS DOUBLE) AS label,
       replace('"' || d.source || '"', '"', '') AS category,
       round(d.n_chars / 1000.0, 6) AS f0,
       round(len(list_filter(string_split(d.text, ' '), lambda t: t <> '')) / 100.0, 6) AS f1,
       round(len(string_split(d.text, chr(10))) / 10.0, 6) AS f2,
       round(d.n_chars / greatest(len(list_filter(string_split(d.text, ' '), lambda t: t <> '')), 1) / 10.0, 6) AS f3,
       round(greatest(CASE WHEN regexp_extract(d.text, '(\d+)', 1) = '' THEN 0.0
                     ELSE TRY_CAST(regexp_extract(d.text, '(\d+)', 1) AS DOUBLE) END, 0.0), 6) AS first_number
FROM labels l JOIN documents d ON l.doc_id = d.doc_id
""")
def page_features(spark, sf_dir):
    t = Tables(spark, sf_dir)
    pc = t.page_classification()
    raw_num = F.regexp_extract(F.col("text"), r"(\d+)", 1)
    first = t.documents.select("doc_id", F.greatest(missing_to_zero(raw_num, ""), F.lit(0.0)).alias("first_number"))
    quoted = F.concat(F.lit('"'), F.col("category"), F.lit('"'))
    out = pc.join(first, "doc_id").select(
        "doc_id", "label", strip_quotes(quoted).alias("category"),
        *[F.round(c, 6).alias(c) for c in ("f0", "f1", "f2", "f3", "first_number")])
    return out


def _gd_data(t, name, materialised=False):
    """Training rows of a linear query; ``materialised`` when several fits
    and metric jobs read them (a single fit persists its own input)."""
    return t.page_classification(materialised) if name in ("logistic_gd", "svm_gd") else \
        t.hourly_demand().withColumnRenamed("cnt", "label")


def _gd_oracle(name):
    cfg = GD[name]
    data = "pc" if name in ("logistic_gd", "svm_gd") else "hdf"
    base = S.PAGES_SQL if data == "pc" else S.HOURLY_SQL
    D = 4 + (1 if cfg["intercept"] else 0)
    return (f"WITH {base},\n" + S.gd_ctes(data, 4, cfg["loss"], cfg["step"], cfg["iters"], cfg["reg"],
                                         cfg["reg_param"], cfg["intercept"])
            + "\n" + S.weights_select(name, f"w{cfg['iters']}", D))


def _gd_plan(name):
    def plan(spark, sf_dir):
        t = Tables(spark, sf_dir)
        model = linear.gd_fit(_gd_data(t, name), **GD[name])
        w = linear.weights_frame(spark, model, name)
        return w.select("model", "j", F.round("weight", 6).alias("weight"), "is_zero")
    plan.__name__ = name
    return plan


for _name in GD:
    register(_name, _gd_oracle(_name))(_gd_plan(_name))


@register("classifier_metrics", "WITH " + S.PAGES_SQL + ",\n"
          + S.gd_ctes("pc", 4, "logistic", 1.0, 10, "none", 0.0, False, "lw") + ",\n"
          + S.gd_ctes("pc", 4, "hinge", 1.0, 10, "l2", 0.01, False, "sw") + """,
lp AS (SELECT CASE WHEN 1.0 / (1.0 + exp(-(""" + S.margin_sql("lw10", 4, False) + """))) > 0.5 THEN 1.0 ELSE 0.0 END AS score,
              label FROM pc, lw10),
sp AS (SELECT CASE WHEN (""" + S.margin_sql("sw10", 4, False) + """) > 0.0 THEN 1.0 ELSE 0.0 END AS score,
              label FROM pc, sw10)
SELECT 'logistic_gd' AS model, (SELECT count(*) FROM lp) AS n,
       CAST((SELECT sum(CASE WHEN score = label THEN 1 ELSE 0 END) FROM lp) AS BIGINT) AS n_correct,
       round((SELECT avg(CASE WHEN score = label THEN 1.0 ELSE 0.0 END) FROM lp), 6) AS accuracy,
       round(a.area_under_roc, 6) AS area_under_roc, round(a.area_under_pr, 6) AS area_under_pr
FROM """ + S.areas_sql("lp") + """ a
UNION ALL
SELECT 'svm_gd', (SELECT count(*) FROM sp), CAST((SELECT sum(CASE WHEN score = label THEN 1 ELSE 0 END) FROM sp) AS BIGINT),
       round((SELECT avg(CASE WHEN score = label THEN 1.0 ELSE 0.0 END) FROM sp), 6),
       round(b.area_under_roc, 6), round(b.area_under_pr, 6)
FROM """ + S.areas_sql("sp") + " b")
def classifier_metrics(spark, sf_dir):
    data = Tables(spark, sf_dir).page_classification(materialised=True)
    outs = []
    names = ("logistic_gd", "svm_gd")
    for name, model in zip(names, linear.gd_fit_many(data, [GD[n] for n in names])):
        sc = data.select(model.predict(F.col("features")).alias("prediction"), "label")
        acc = metrics.accuracy(sc)
        # hard 0/1 predictions: both curve areas from one confusion-count aggregate
        h = metrics.hard_label_summary(sc)
        outs.append(acc.select(
            F.lit(name).alias("model"), "n", "n_correct", F.round("accuracy", 6).alias("accuracy"),
            F.round(F.lit(h["area_under_roc"]), 6).alias("area_under_roc"),
            F.round(F.lit(h["area_under_pr"]), 6).alias("area_under_pr")))
    return outs[0].unionByName(outs[1])


@register("score_curve_areas", "WITH " + S.PAGES_SQL + ",\n"
          + S.gd_ctes("pc", 4, "logistic", 1.0, 10, "none", 0.0, False, "lw") + ",\n"
          + S.gd_ctes("pc", 4, "hinge", 1.0, 10, "l2", 0.01, False, "sw") + """,
lp AS (SELECT 1.0 / (1.0 + exp(-(""" + S.margin_sql("lw10", 4, False) + """))) AS score, label FROM pc, lw10),
sp AS (SELECT """ + S.margin_sql("sw10", 4, False) + """ AS score, label FROM pc, sw10)
SELECT 'logistic_gd' AS model, round(a.area_under_roc, 6) AS area_under_roc, round(a.area_under_pr, 6) AS area_under_pr
FROM """ + S.areas_sql("lp") + """ a
UNION ALL
SELECT 'svm_gd', round(b.area_under_roc, 6), round(b.area_under_pr, 6) FROM """ + S.areas_sql("sp") + " b")
def score_curve_areas(spark, sf_dir):
    """Areas under the ROC and precision-recall curves over the scores of both
    classifiers (probabilities, margins), fitted in one descent."""
    data = Tables(spark, sf_dir).page_classification(materialised=True)
    names = ("logistic_gd", "svm_gd")
    outs = []
    for name, model in zip(names, linear.gd_fit_many(data, [GD[n] for n in names])):
        scored = data.select(model.score(F.col("features")).alias("score"), "label")
        areas = metrics.binary_areas(scored, "score", "label")
        outs.append(areas.select(F.lit(name).alias("model"), F.round("area_under_roc", 6).alias("area_under_roc"),
                                 F.round("area_under_pr", 6).alias("area_under_pr")))
    return outs[0].unionByName(outs[1])


def _category_nb(t, smoothing=1.0):
    pc = t.page_classification(materialised=True)
    idx = encode.category_index(pc, "category")
    docs = pc.select("doc_id", "label")
    long = pc.join(idx, "category").select("doc_id", F.col("category_index").alias("j"), F.lit(1.0).alias("x"))
    k = idx.count()   # number of categories: model-sized
    model = bayes.fit(docs, long, k, smoothing)
    return docs, bayes.predict(model, docs, long)


@register("naive_bayes_categorical", "WITH " + S.PAGES_SQL + """,
cidx AS (SELECT category, row_number() OVER (ORDER BY category) - 1 AS j FROM (SELECT DISTINCT category FROM pc)),
cdocs AS (SELECT doc_id, label FROM pc),
clong AS (SELECT pc.doc_id, cidx.j, 1.0 AS x FROM pc JOIN cidx ON pc.category = cidx.category),
""" + S.nb_scores_sql("cdocs", "clong", "(SELECT count(*) FROM cidx)", 1.0).lstrip().rstrip(",") + """
SELECT doc_id, label, prediction FROM nbpred
""")
def naive_bayes_categorical(spark, sf_dir):
    docs, pred = _category_nb(Tables(spark, sf_dir))
    return docs.join(pred, "doc_id").select("doc_id", "label", "prediction")


def _text_nb(t, smoothing=0.1):
    d = t.documents
    lab = encode.category_index(d, "lang", "label")
    docs = d.select("doc_id", "lang").join(lab, "lang").select("doc_id", F.col("label").cast("double").alias("label"))
    tf = _pruned_tf(d)
    # features are keyed by the term itself: naive Bayes needs only the
    # vocabulary size, not a dense index
    long = tf.select("doc_id", F.col("term").alias("j"), F.col("tf").cast("double").alias("x"))
    v = tf.select("term").distinct().count()
    model = bayes.fit(docs, long, v, smoothing)
    return docs, bayes.predict(model, docs, long)


@register("naive_bayes_text", "WITH " + S.TEXT_NB_SQL.lstrip() + ",\n"
          + S.nb_scores_sql("tdocs", "tlong", "(SELECT count(*) FROM vocab)", 0.1).lstrip() + """
SELECT doc_id, label, prediction FROM nbpred
""")
def naive_bayes_text(spark, sf_dir):
    docs, pred = _text_nb(Tables(spark, sf_dir))
    return docs.join(pred, "doc_id").select("doc_id", "label", "prediction")


@register("weighted_f", "WITH " + S.TEXT_NB_SQL.lstrip() + ",\n"
          + S.nb_scores_sql("tdocs", "tlong", "(SELECT count(*) FROM vocab)", 0.1).lstrip() + """,
conf AS (SELECT label AS l, prediction AS p, count(*) AS c FROM nbpred GROUP BY label, prediction),
per AS (SELECT a.k, a.n_actual, coalesce(pp.n_pred, 0) AS n_pred, coalesce(tp.tp, 0) AS tp
        FROM (SELECT l AS k, sum(c) AS n_actual FROM conf GROUP BY l) a
        LEFT JOIN (SELECT p AS k, sum(c) AS n_pred FROM conf GROUP BY p) pp ON a.k = pp.k
        LEFT JOIN (SELECT l AS k, c AS tp FROM conf WHERE l = p) tp ON a.k = tp.k),
pr AS (SELECT n_actual, CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS prec, tp / n_actual AS rec FROM per)
SELECT round(sum(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END * n_actual) / sum(n_actual), 6)
         AS weighted_f_measure,
       round(sum(prec * n_actual) / sum(n_actual), 6) AS weighted_precision,
       round(sum(rec * n_actual) / sum(n_actual), 6) AS weighted_recall,
       round((SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) FROM nbpred), 6) AS accuracy
FROM pr
""")
def weighted_f(spark, sf_dir):
    docs, pred = _text_nb(Tables(spark, sf_dir))
    sc = docs.join(pred, "doc_id")
    wf = metrics.weighted_f_measure(sc)
    acc = metrics.accuracy(sc).select("accuracy")
    return attach_row(wf, acc).select(*[F.round(c, 6).alias(c) for c in (
        "weighted_f_measure", "weighted_precision", "weighted_recall", "accuracy")])


@register("hash_split_sizes", """
WITH b AS (SELECT CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000 AS bucket, value FROM events)
SELECT CASE WHEN bucket < 200 THEN 'test' ELSE 'train' END AS split, count(*) AS n,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum
FROM b GROUP BY 1
UNION ALL
SELECT 'sample_10pct', count(*), CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) FROM b WHERE bucket < 100
""")
def hash_split_sizes(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    from ..operators.common import money
    b = tune.hash_bucket(F.col("event_id"))
    parts = F.array(F.when(b < 200, "test").otherwise("train"), F.when(b < 100, "sample_10pct"))
    rows = ev.select(F.explode(F.array_compact(parts)).alias("split"), money("value").alias("v"))
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("v").cast("double").alias("value_sum"))


@register("anti_join_train", """
WITH b AS (SELECT event_id, CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 1000 AS bucket FROM events),
test AS (SELECT event_id FROM b WHERE bucket < 200),
train AS (SELECT e.event_id, e.value FROM events e WHERE NOT EXISTS (SELECT 1 FROM test t WHERE t.event_id = e.event_id))
SELECT count(*) AS n_train, (SELECT count(*) FROM test) AS n_test,
       count(*) + (SELECT count(*) FROM test) = (SELECT count(*) FROM events) AS sizes_add_up
FROM train
""")
def anti_join_train(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    _, test = tune.hash_split(ev, "event_id", 0.2)
    train = ev.join(test.select("event_id"), "event_id", "left_anti")
    n_train = train.agg(F.count(F.lit(1)).alias("n_train"))
    n_test = test.agg(F.count(F.lit(1)).alias("n_test"))
    n_all = ev.agg(F.count(F.lit(1)).alias("_n"))
    out = attach_row(attach_row(n_train, n_test), n_all)
    return out.select("n_train", "n_test", ((F.col("n_train") + F.col("n_test")) == F.col("_n")).alias("sizes_add_up"))


_TT_SQL = "WITH " + S.HOURLY_SQL.lstrip() + """,
t AS (SELECT 'none' AS transform, hr, cnt AS label, cnt AS y FROM hdf
      UNION ALL SELECT 'log', hr, cnt, ln(cnt) FROM hdf
      UNION ALL SELECT 'sqrt', hr, cnt, sqrt(cnt) FROM hdf),
m AS (SELECT transform, hr, avg(y) AS my FROM t GROUP BY transform, hr),
p AS (SELECT t.transform, t.label,
             CASE t.transform WHEN 'log' THEN exp(m.my) WHEN 'sqrt' THEN m.my * m.my ELSE m.my END AS prediction
      FROM t JOIN m ON t.transform = m.transform AND t.hr = m.hr)"""


@register("target_transforms", _TT_SQL + """
SELECT transform, count(*) AS n, round(avg((prediction - label) * (prediction - label)), 6) AS mse,
       round(avg(abs(prediction - label)), 6) AS mae,
       round(sqrt(avg(pow(ln(1 + greatest(prediction, 0)) - ln(1 + label), 2))), 6) AS rmsle
FROM p GROUP BY transform
""")
def target_transforms(spark, sf_dir):
    hd = Tables(spark, sf_dir).hourly_demand()
    outs = []
    for name in ("none", "log", "sqrt"):
        p = tune.group_mean_predictions(hd, "hr", "cnt", name)
        m = metrics.regression_metrics(p, "prediction", "label")
        outs.append(m.select(F.lit(name).alias("transform"), "n", *[F.round(c, 6).alias(c)
                                                                   for c in ("mse", "mae", "rmsle")]))
    return outs[0].unionByName(outs[1]).unionByName(outs[2])


@register("regression_metrics", _TT_SQL + """
SELECT count(*) AS n, round(avg((prediction - label) * (prediction - label)), 6) AS mse,
       round(sqrt(avg((prediction - label) * (prediction - label))), 6) AS rmse,
       round(avg(abs(prediction - label)), 6) AS mae,
       round(sqrt(avg(pow(ln(1 + greatest(prediction, 0)) - ln(1 + label), 2))), 6) AS rmsle
FROM p WHERE transform = 'none'
""")
def regression_metrics(spark, sf_dir):
    hd = Tables(spark, sf_dir).hourly_demand()
    p = tune.group_mean_predictions(hd, "hr", "cnt", "none")
    m = metrics.regression_metrics(p, "prediction", "label")
    return m.select("n", *[F.round(c, 6).alias(c) for c in ("mse", "rmse", "mae", "rmsle")])


def _grid(base: dict, **values) -> list[tuple[str, object, dict]]:
    """(name, value, settings) of one-at-a-time variations of ``base``."""
    to_settings = {"iterations": lambda v: {"iters": v}, "step": lambda v: {"step": v},
                   "l2": lambda v: {"reg": "l2", "reg_param": v}, "l1": lambda v: {"reg": "l1", "reg_param": v},
                   "intercept": lambda v: {"intercept": bool(v)}}
    return [(name, v, {**base, **to_settings[name](v)}) for name, vs in values.items() for v in vs]


# The swept settings.
LOGISTIC_GRID = _grid(dict(loss="logistic", step=1.0, iters=10, reg="none", reg_param=0.0, intercept=False),
                      iterations=(1, 5, 10, 50), step=(0.001, 0.01, 0.1, 1.0, 10.0), l2=(0.001, 0.01, 0.1, 1.0, 10.0))
LINEAR_GRID = _grid(dict(loss="squared", step=0.1, iters=10, reg="none", reg_param=0.0, intercept=False),
                    iterations=(1, 5, 10, 20, 50, 100), step=(0.01, 0.025, 0.05, 0.1, 1.0),
                    l2=(0.0, 0.01, 0.1, 1.0, 5.0, 10.0, 20.0), l1=(0.0, 0.01, 0.1, 1.0, 10.0, 100.0, 1000.0),
                    intercept=(0, 1))
_BUCKET_SQL = "CAST('0x' || substr(md5(CAST({} AS VARCHAR)), 1, 8) AS BIGINT) % 1000"
_MARGIN_SQL = "a0 * x0 + a1 * x1 + a2 * x2 + a3 * x3 + a4 * icpt"


@register("logistic_sweep", "WITH RECURSIVE " + S.PAGES_SQL + """,
zs AS (SELECT """ + ", ".join(f"avg(x{j}) AS m{j}, stddev_samp(x{j}) AS s{j}" for j in range(4)) + """ FROM pc),
z AS (SELECT doc_id, label, """ + _BUCKET_SQL.format("doc_id") + " < 400 AS held, "
          + ", ".join(f"CASE WHEN s{j} = 0 THEN 0.0 ELSE (x{j} - m{j}) / s{j} END AS x{j}" for j in range(4)) + """
      FROM pc, zs),
tr AS MATERIALIZED (SELECT * FROM z WHERE NOT held),
""" + S.sweep_ctes(LOGISTIC_GRID, "tr", 4) + """,
p AS (SELECT param, value, held, label, 1.0 / (1.0 + exp(-(""" + _MARGIN_SQL + """))) > 0.5 AS hit FROM fw CROSS JOIN z),
r AS (SELECT param, value, held,
             (count_if(hit AND label > 0.5) / count_if(label > 0.5)
              + count_if(NOT hit AND label <= 0.5) / count_if(label <= 0.5)) / 2 AS auc FROM p GROUP BY ALL)
SELECT param, value, round(max(CASE WHEN NOT held THEN auc END), 6) AS train_auc,
       round(max(CASE WHEN held THEN auc END), 6) AS test_auc
FROM r GROUP BY param, value
""")
def logistic_sweep(spark, sf_dir):
    """Iterations, step and L2 sweeps of the logistic model on standardised
    features; AUC (hard labels) on a 60/40 keyed hold-out."""
    pc = Tables(spark, sf_dir).page_classification(materialised=True)
    z = encode.standardise(pc, "features", "features_z").select("doc_id", F.col("features_z").alias("features"),
                                                                  "label")
    train, test = tune.hash_split(z, "doc_id", 0.4)
    train, test = train.persist(), test.persist()
    try:
        models = linear.gd_fit_many(train, [cfg for _, _, cfg in LOGISTIC_GRID])

        def aucs(df):   # every model's hard-label AUC from one aggregate
            preds = df.select("label", *[m.predict(F.col("features")).alias(f"p{i}") for i, m in enumerate(models)])
            return metrics.hard_label_roc_many(preds, [f"p{i}" for i in range(len(models))])
        tr, te = aucs(train), aucs(test)
    finally:
        train.unpersist()
        test.unpersist()
    rows = [(name, float(v), float(a), float(b)) for (name, v, _), a, b in zip(LOGISTIC_GRID, tr, te)]
    return spark.createDataFrame(rows, "param string, value double, train_auc double, test_auc double").select(
        "param", "value", F.round("train_auc", 6).alias("train_auc"), F.round("test_auc", 6).alias("test_auc"))


@register("linear_sweep", "WITH RECURSIVE " + S.HOURLY_SQL + """,
z AS MATERIALIZED (SELECT x0, x1, x2, x3, label, """ + _BUCKET_SQL.format("CAST(epoch(hour_start) AS BIGINT)")
          + """ < 300 AS held FROM hdf),
tr AS MATERIALIZED (SELECT * FROM z WHERE NOT held),
""" + S.sweep_ctes(LINEAR_GRID, "tr", 4) + """,
p AS (SELECT param, value, held, label, """ + _MARGIN_SQL + """ AS y FROM fw CROSS JOIN z),
r AS (SELECT param, value, held, sqrt(avg(pow(ln(1 + greatest(y, 0)) - ln(1 + label), 2))) AS e FROM p GROUP BY ALL)
SELECT r.param, r.value, round(max(CASE WHEN NOT held THEN e END), 6) AS train_rmsle,
       round(max(CASE WHEN held THEN e END), 6) AS test_rmsle,
       CAST(max((CASE WHEN a0 = 0 THEN 1 ELSE 0 END) + (CASE WHEN a1 = 0 THEN 1 ELSE 0 END)
                + (CASE WHEN a2 = 0 THEN 1 ELSE 0 END) + (CASE WHEN a3 = 0 THEN 1 ELSE 0 END)) AS INTEGER) AS zero_weights
FROM r JOIN fw ON r.param = fw.param AND r.value = fw.value GROUP BY r.param, r.value
""")
def linear_sweep(spark, sf_dir):
    """Iterations, step, L1 / L2 and intercept sweeps of the squared-loss
    model on hourly demand: RMSLE on a 70/30 keyed hold-out, and how many of
    the four feature weights are exactly zero."""
    hd = Tables(spark, sf_dir).hourly_demand().withColumnRenamed("cnt", "label")
    hd = hd.withColumn("_key", F.unix_timestamp(F.col("hour_start").cast("timestamp")))
    train, test = tune.hash_split(hd, "_key", 0.3)
    train, test = train.persist(), test.persist()
    try:
        models = linear.gd_fit_many(train, [cfg for _, _, cfg in LINEAR_GRID])

        def rmsles(df):   # every model's error from one aggregate
            y = F.log1p(F.col("label"))
            errs = [F.pow(F.log1p(F.greatest(m.predict(F.col("features")), F.lit(0.0))) - y, 2) for m in models]
            return df.agg(*[F.sqrt(F.avg(e)).alias(f"e{i}") for i, e in enumerate(errs)]).first()
        tr, te = rmsles(train), rmsles(test)
    finally:
        train.unpersist()
        test.unpersist()
    rows = [(name, float(v), tr[i], te[i], sum(1 for w in models[i].weights[:4] if w == 0.0))
            for i, (name, v, _) in enumerate(LINEAR_GRID)]
    return spark.createDataFrame(
        rows, "param string, value double, train_rmsle double, test_rmsle double, zero_weights int").select(
        "param", "value", F.round("train_rmsle", 6).alias("train_rmsle"), F.round("test_rmsle", 6).alias("test_rmsle"),
        "zero_weights")


@register("naive_bayes_numeric", "WITH " + S.PAGES_SQL + """,
ndocs AS (SELECT doc_id, label FROM pc),
nlong AS (SELECT doc_id, 0 AS j, greatest(x0, 0.0) AS x FROM pc UNION ALL SELECT doc_id, 1, greatest(x1, 0.0) FROM pc
          UNION ALL SELECT doc_id, 2, greatest(x2, 0.0) FROM pc UNION ALL SELECT doc_id, 3, greatest(x3, 0.0) FROM pc),
""" + S.nb_scores_sql("ndocs", "nlong", "4", 1.0).lstrip().rstrip(",") + """
SELECT doc_id, label, prediction FROM nbpred
""")
def naive_bayes_numeric(spark, sf_dir):
    """Multinomial naive Bayes on the numeric page features, negatives
    clamped to zero (the model needs non-negative counts)."""
    pc = Tables(spark, sf_dir).page_classification(materialised=True)
    docs = pc.select("doc_id", "label")
    # all four numeric fields (positions 0..3) of the assembled vector
    long = pc.select("doc_id", F.posexplode(encode.feature_range("features", 0, 4)).alias("j", "x")).select(
        "doc_id", "j", F.greatest(F.col("x"), F.lit(0.0)).alias("x"))
    model = bayes.fit(docs, long, 4, 1.0)
    return docs.join(bayes.predict(model, docs, long), "doc_id").select("doc_id", "label", "prediction")
