"""Fits that SQL restates: least squares half steps, and k-means over a grid
of k with several starts and a hold-out."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..operators import als, cluster, tune
from ..sources import Tables
from ..sources.files import discard, materialise
from .catalog import register
from .cluster_plans import LLOYD_ITERS
from .model_plans import _BUCKET_SQL
from .profile_plans import RATINGS_SQL

KS = (2, 3, 4, 5, 10, 20)   # fixed values: swept numbers of clusters
REG = 0.1


def _solve_sql(name: str, side: str, other: str, fixed: str) -> str:
    """One half step at rank 2: the 2 x 2 ridge system of every row by Cramer's rule."""
    return f"""{name} AS (
  SELECT id, (c * y0 - b * y1) / (a * c - b * b) AS f0, (a * y1 - b * y0) / (a * c - b * b) AS f1 FROM (
    SELECT r.{side} AS id, sum(f0 * f0) + {REG} * count(*) AS a, sum(f0 * f1) AS b, sum(f1 * f1) + {REG} * count(*) AS c,
           sum(rating * f0) AS y0, sum(rating * f1) AS y1
    FROM ratings r JOIN {fixed} f ON r.{other} = f.id GROUP BY r.{side}))"""


_START = "({} + 1) / 1000.0"


@register("als_half_steps", f"""
WITH {RATINGS_SQL},
v0 AS (SELECT id, CAST({_START.format(_BUCKET_SQL.format("CAST(id AS VARCHAR) || ':0'"))} AS DOUBLE) AS f0,
              CAST({_START.format(_BUCKET_SQL.format("CAST(id AS VARCHAR) || ':1'"))} AS DOUBLE) AS f1
       FROM (SELECT DISTINCT item AS id FROM ratings)),
{_solve_sql("u1", '"user"', "item", "v0")},
{_solve_sql("v1", "item", '"user"', "u1")}
SELECT 'user' AS side, id, round(f0, 6) AS f0, round(f1, 6) AS f1 FROM u1
UNION ALL SELECT 'item', id, round(f0, 6), round(f1, 6) FROM v1
""")
def als_half_steps(spark, sf_dir):
    """Factors of rank 2 after one user and one item half step."""
    users, items = als.fit(Tables(spark, sf_dir).ratings(), 2, 1, REG)
    both = users.select(F.lit("user").alias("side"), "id", "features").unionByName(
        items.select(F.lit("item").alias("side"), "id", "features"))
    return both.select("side", "id", *[F.round(F.col("features")[j], 6).alias(f"f{j}") for j in range(2)])


@register("als_descent", f"""
WITH {RATINGS_SQL}
SELECT count(*) AS n, count(DISTINCT "user") AS n_users, count(DISTINCT item) AS n_items, TRUE AS falls, TRUE AS below_item_means
FROM ratings
""")
def als_descent(spark, sf_dir):
    """Three rounds at rank 10: no half step raises the penalised loss, and the
    error ends below that of the items' mean ratings."""
    reg = 0.01
    with als.known_ratings(Tables(spark, sf_dir).ratings()) as known:
        items = als.hashed_start(known.rows.select(F.col("item").alias("id")).distinct(), 10)
        seen, users = [], None
        for k in range(3):
            old = [users, items] if k else []
            users = materialise(als.half_step(known, items, "user", 10, reg), "user-factors")
            seen.append(als.loss(known, users, items, reg).first())
            items = materialise(als.half_step(known, users, "item", 10, reg), "item-factors")
            seen.append(als.loss(known, users, items, reg).first())
            known.release()
            for f in old:
                discard(f)
    total = [(r["sq_error"] or 0.0) + (r["penalty"] or 0.0) for r in seen]
    falls = all(b <= a * (1 + 1e-9) for a, b in zip(total, total[1:]))
    spread = known.rows.groupBy("item").agg((F.var_pop("rating") * F.count(F.lit(1))).alias("ss")).agg(F.sum("ss")).first()[0] or 0.0
    return known.rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user").alias("n_users"),
                          F.count_distinct("item").alias("n_items")).select(
        "*", F.lit(falls).alias("falls"), F.lit((seen[-1]["sq_error"] or 0.0) <= spread + 1e-9).alias("below_item_means"))


def _grid_sql() -> str:
    grid = " UNION ALL ".join(f"SELECT {k} AS k" for k in KS)
    parts = [f"""e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, {_BUCKET_SQL.format("vec_id")} < 400 AS held FROM embeddings)""",
             "x AS (SELECT vec_id, unnest(range(len(v))) AS dim, unnest(v) AS x FROM e WHERE NOT held)",
             f"g AS ({grid})",
             """c0 AS (SELECT k, place AS cluster, v AS cv FROM g JOIN
                (SELECT v, row_number() OVER (ORDER BY vec_id) - 1 AS place FROM e WHERE NOT held) s ON place < k)"""]
    def near(i: int, name: str, rows: str) -> str:
        return f"""{name} AS (SELECT k, vec_id, arg_min(cluster, struct_pack(a := d, b := cluster)) AS cluster, min(d) AS d FROM (
          SELECT c.k, e.vec_id, c.cluster, list_sum(list_transform(list_zip(e.v, c.cv), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
          FROM e, c{i} c WHERE {rows}) GROUP BY k, vec_id)"""
    for i in range(LLOYD_ITERS):
        parts.append(near(i, f"a{i}", "NOT held"))
        parts.append(f"""c{i + 1} AS (SELECT k, cluster, list(m ORDER BY dim) AS cv FROM (
          SELECT a.k, a.cluster, x.dim, avg(x.x) AS m FROM a{i} a JOIN x ON a.vec_id = x.vec_id GROUP BY ALL) GROUP BY k, cluster
          UNION ALL SELECT k, cluster, cv FROM c{i} WHERE (k, cluster) NOT IN (SELECT (k, cluster) FROM a{i}))""")
    parts += [near(LLOYD_ITERS, "train", "NOT held"), near(LLOYD_ITERS, "test", "held")]
    return "WITH " + ",\n".join(parts) + """
SELECT CAST(g.k AS INTEGER) AS k, round((SELECT sum(d) FROM train t WHERE t.k = g.k), 6) AS train_cost,
       round((SELECT sum(d) FROM test t WHERE t.k = g.k), 6) AS test_cost FROM g
"""


@register("kmeans_grid", _grid_sql())
def kmeans_grid(spark, sf_dir):
    """All k in the same passes by matrix products: Lloyd iterations from the
    vectors with the smallest ids, training and hold-out cost."""
    train, test = tune.hash_split(Tables(spark, sf_dir).embeddings, "vec_id", 0.4)
    first = cluster.first_k_centres(train, "vec_id", "embedding", max(KS))
    got = cluster.sweep_k(train, "vec_id", "embedding", list(KS), 1, LLOYD_ITERS, test, [np.array(first[:k]) for k in KS])
    rows = [(r["k"], r["cost"], r["held_cost"]) for r in got]
    out = spark.createDataFrame(rows, "k int, train_cost double, test_cost double")
    return out.select("k", *[F.round(c, 6).alias(c) for c in ("train_cost", "test_cost")])


@register("factor_k_sweep", f"""
WITH {RATINGS_SQL},
ids AS (SELECT 'user' AS side, "user" AS id FROM ratings UNION SELECT 'item', item FROM ratings),
n AS (SELECT side, count(*) FILTER (NOT held) AS n_train, count(*) FILTER (held) AS n_test
      FROM (SELECT side, {_BUCKET_SQL.format("id")} < 300 AS held FROM ids) GROUP BY side)
SELECT n.side, CAST(k AS INTEGER) AS k, n_train, n_test, TRUE AS below_one_cluster, TRUE AS best_of_runs, TRUE AS held_out_measured
FROM n, (SELECT unnest({list(KS)}) AS k)
""")
def factor_k_sweep(spark, sf_dir):
    """k of k-means over the factor vectors of users and of items, three starts
    each, 30 % held out: the cost is below that of one cluster, no start alone
    is better than the kept one, and the held-out cost equals that of a plain assignment."""
    users, items = als.fit(Tables(spark, sf_dir).ratings(), 10, 3)
    rows = []
    for side, factors in (("user", users), ("item", items)):
        train, test = tune.hash_split(factors, "id", 0.3)
        n_train, n_test = train.count(), test.count()
        one = cluster.sweep_k(train, "id", "features", [1], 1, 1)
        alone = {r["k"]: r["cost"] for r in cluster.sweep_k(train, "id", "features", list(KS), 1)}
        for r in cluster.sweep_k(train, "id", "features", list(KS), held_out=test):
            plain = cluster.wcss(cluster.assign_blocks(test, "features", r["centres"])).first()["wcss"] or 0.0
            rows.append((side, r["k"], n_train, n_test, r["cost"] <= one[0]["cost"] * (1 + 1e-9),
                         r["cost"] <= alone[r["k"]] * (1 + 1e-9), abs(plain - r["held_cost"]) <= 1e-9 * (1 + plain)))
    return spark.createDataFrame(rows, "side string, k int, n_train long, n_test long, below_one_cluster boolean, "
                                       "best_of_runs boolean, held_out_measured boolean")
