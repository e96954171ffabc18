"""Plans of the converged solvers and of the truncated decomposition."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import decompose, solvers
from ..operators.common import attach_row
from ..sources import Tables
from . import model_sql as S
from .catalog import register


@register("linear_solve", "WITH " + S.HOURLY_SQL + """,
m AS (SELECT var_pop(x0) AS a, var_pop(x2) AS b, covar_pop(x0, x2) AS c, covar_pop(x0, label) AS u, covar_pop(x2, label) AS v,
             avg(x0) AS m0, avg(x2) AS m2, avg(label) AS my FROM hdf),
w AS (SELECT (u * b - v * c) / (a * b - c * c) AS w0, (v * a - u * c) / (a * b - c * c) AS w1, m0, m2, my FROM m)
SELECT unnest(['hour', 'weekend', 'intercept']) AS term,
       unnest([round(w0, 6), round(w1, 6), round(my - w0 * m0 - w1 * m2, 6)]) AS weight FROM w
""")
def linear_solve(spark, sf_dir):
    """Least squares of hourly demand on hour and weekend; the SQL solves the two centred equations."""
    hd = Tables(spark, sf_dir).hourly_demand().withColumn("features", F.array(F.col("features")[0], F.col("features")[2]))
    w = solvers.linear_regression(hd, label="cnt").weights
    return spark.createDataFrame([(t, round(x, 6)) for t, x in zip(("hour", "weekend", "intercept"), w)], "term string, weight double")


@register("logistic_solve", """
WITH e AS (SELECT CASE WHEN dayofweek(ts) IN (0, 6) THEN 1 ELSE 0 END AS x, CASE WHEN value > 20 THEN 1 ELSE 0 END AS y,
                  CASE WHEN event_type IN ('purchase', 'error') THEN 1.0 ELSE 0.0 END AS label FROM events),
c AS (SELECT x, y, ln(avg(label) / (1 - avg(label))) AS l FROM e GROUP BY x, y),
p AS (SELECT max(l) FILTER (x = 0 AND y = 0) AS a, max(l) FILTER (x = 1 AND y = 0) AS b,
             max(l) FILTER (x = 0 AND y = 1) AS c, max(l) FILTER (x = 1 AND y = 1) AS d FROM c)
SELECT unnest(['weekend', 'dear', 'both', 'intercept']) AS term,
       unnest([round(b - a, 6), round(c - a, 6), round(d - b - c + a, 6), round(a, 6)]) AS weight, TRUE AS converged FROM p
""")
def logistic_solve(spark, sf_dir):
    """Logistic regression on two flags and their product; a saturated model, so the SQL has the log odds of the four cells."""
    e = Tables(spark, sf_dir).events
    x = F.dayofweek("ts").isin(1, 7).cast("double")
    y = (F.col("value") > 20).cast("double")
    data = e.select(F.array(x, y, x * y).alias("features"), F.col("event_type").isin("purchase", "error").cast("double").alias("label"))
    fit = solvers.logistic_regression(data)
    terms = ("weekend", "dear", "both", "intercept")
    return spark.createDataFrame([(t, round(w, 6), fit.gradient < 1e-8) for t, w in zip(terms, fit.model.weights)],
                                 "term string, weight double, converged boolean")


@register("svd_truncated_checks", """
WITH x AS (SELECT vec_id, generate_subscripts(embedding, 1) AS j, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
m AS (SELECT j, avg(v) AS mean FROM x GROUP BY j)
SELECT count(DISTINCT vec_id) AS n_rows, 5 AS k, round(sum((v - mean) * (v - mean)), 4) AS total_squares,
       TRUE AS values_fall, TRUE AS equal_to_gramian, TRUE AS u_orthonormal, TRUE AS below_total,
       TRUE AS squares_add_up, TRUE AS shares_rise_to_one
FROM x JOIN m ON x.j = m.j
""")
def svd_truncated_checks(spark, sf_dir):
    """Singular values by block power against those of the Gramian, and the
    Gramian of U against the identity; the whole spectrum's squares add up to
    the total and its cumulative shares rise to one. The SQL recomputes the rows and the sum of squares."""
    e = Tables(spark, sf_dir).embeddings.select("vec_id", "embedding")
    k = 5
    svd = solvers.truncated_svd(e, "embedding", k, extra=24)
    g = decompose.gramian_matrix(decompose.gramian_rows(e, "embedding"))
    spectrum, _ = decompose.svd_from_gramian(g, len(g))
    known = spectrum[:k]
    share = spectrum.cumsum() / spectrum.sum()
    rises = bool((share[1:] >= share[:-1]).all() and abs(share[-1] - 1.0) < 1e-12 and (spectrum[1:] <= spectrum[:-1]).all())
    u = svd.left(e, "vec_id", "embedding")
    uu = decompose.gramian(u, "u", centre=False)
    unit = uu.agg(F.max(F.abs(F.col("value") - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))).alias("off"))
    falls = bool((svd.values[1:] <= svd.values[:-1]).all())
    same = bool((abs(svd.values - known) <= 1e-6 * known[0]).all())
    mean = F.array(*[F.lit(float(v)) for v in svd.mean])
    squares = F.aggregate(F.zip_with(F.col("embedding"), mean, lambda a, m: (a.cast("double") - m) * (a.cast("double") - m)),
                          F.lit(0.0), lambda s, x: s + x)
    total = e.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(squares).alias("total"))
    return attach_row(total, unit).select(
        "n_rows", F.lit(k).alias("k"), F.round("total", 4).alias("total_squares"), F.lit(falls).alias("values_fall"),
        F.lit(same).alias("equal_to_gramian"), (F.col("off") < 1e-6).alias("u_orthonormal"),
        (F.lit(float((svd.values ** 2).sum())) <= F.col("total")).alias("below_total"),
        (F.abs(F.lit(float((spectrum ** 2).sum())) - F.col("total")) <= 1e-9 * F.col("total")).alias("squares_add_up"),
        F.lit(rises).alias("shares_rise_to_one"))
