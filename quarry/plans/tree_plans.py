"""Trees grown from histograms, with the split search restated in SQL level by level."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import histogram_tree
from ..sources import Tables
from . import model_sql as S
from .catalog import register

DEPTH, BINS = 3, 8   # fixed values


def _tree_sql() -> str:
    """Nodes of each level: histogram, running sums, best cut, rows to the children."""
    bins = ", ".join(f"CAST(least(floor((x{j} - lo{j}) / (hi{j} - lo{j}) * {BINS}), {BINS - 1}) AS INTEGER) AS b{j}" for j in range(4))
    ends = ", ".join(f"min(x{j}) AS lo{j}, max(x{j}) AS hi{j}" for j in range(4))
    out = [f"r0 AS MATERIALIZED (SELECT 0 AS node, label AS y, {bins} FROM hdf, (SELECT {ends} FROM hdf))"]
    for k in range(DEPTH):
        cells = " UNION ALL ".join(f"SELECT node, {j} AS f, b{j} AS b, y FROM r{k}" for j in range(4))
        out.append(f"""
h{k} AS (SELECT node, f, b, count(*) AS n, sum(y) AS s FROM ({cells}) GROUP BY node, f, b),
t{k} AS (SELECT node, count(*) AS n, sum(y) AS s FROM r{k} GROUP BY node),
c{k} AS (SELECT h.node, f, b, sum(h.n) OVER w AS n, sum(h.s) OVER w AS s, t.n AS tn, t.s AS ts FROM h{k} h JOIN t{k} t ON t.node = h.node
         WINDOW w AS (PARTITION BY h.node, f ORDER BY b)),
g{k} AS (SELECT node, f, b, s * s / n + (ts - s) * (ts - s) / (tn - n) - ts * ts / tn AS gain FROM c{k} WHERE n < tn),
s{k} AS MATERIALIZED (SELECT node, f, b FROM g{k} WHERE gain > 1e-9 QUALIFY row_number() OVER (PARTITION BY node ORDER BY round(gain, 6) DESC, f, b) = 1),
r{k + 1} AS MATERIALIZED (SELECT 2 * r.node + 2 - CASE WHEN (CASE f WHEN 0 THEN b0 WHEN 1 THEN b1 WHEN 2 THEN b2 ELSE b3 END) <= s.b THEN 1 ELSE 0 END AS node,
         y, b0, b1, b2, b3 FROM r{k} r JOIN s{k} s ON s.node = r.node)""")
    return ",\n".join(out)


_LEVELS = " UNION ALL ".join(
    f"SELECT r.node, {k} AS depth, count(*) AS n, round(avg(y), 6) AS mean, any_value(s.f) AS feature, any_value(s.b) AS last_left_bin "
    f"FROM r{k} r LEFT JOIN {f's{k}' if k < DEPTH else '(SELECT 0 AS node, 0 AS f, 0 AS b WHERE false)'} s ON s.node = r.node GROUP BY r.node"
    for k in range(DEPTH + 1))


def _tree(spark, sf_dir):
    hd = Tables(spark, sf_dir).hourly_demand().select("features", F.col("cnt").alias("label"))
    return hd, histogram_tree.grow(hd, depth=DEPTH, bins=BINS)


@register("tree_levels", "WITH " + S.HOURLY_SQL + ",\n" + _tree_sql() + f"""
SELECT CAST(node AS BIGINT) AS node, CAST(depth AS BIGINT) AS depth, n, mean, coalesce(CAST(feature AS BIGINT), -1) AS feature,
       coalesce(CAST(last_left_bin AS BIGINT), -1) AS last_left_bin FROM ({_LEVELS})
""")
def tree_levels(spark, sf_dir):
    """Every node of a regression tree on hourly demand: rows, mean, and the split it has (-1: none)."""
    _, tree = _tree(spark, sf_dir)
    rows = [(i, histogram_tree.level(i), int(n.n), round(n.mean, 6), -1 if n.feature is None else n.feature,
             -1 if n.left is None else int(n.left.nonzero()[0].max()))
            for i, n in tree.nodes.items()]
    return spark.createDataFrame(rows, "node long, depth long, n long, mean double, feature long, last_left_bin long")


def _depth_sql() -> str:
    """Per depth, the squares around the means of the leaves: nodes of that depth, and shallower ones without a split."""
    parts = []
    for depth in range(1, DEPTH + 1):
        leaves = f"SELECT node, y FROM r{depth}" + "".join(
            f" UNION ALL SELECT node, y FROM r{k} WHERE node NOT IN (SELECT node FROM s{k})" for k in range(depth))
        parts.append(f"SELECT {depth} AS depth, sum(n) AS n, round(sum(e) / sum(n), 6) AS mse FROM (SELECT count(*) AS n, "
                     f"sum(y * y) - sum(y) * sum(y) / count(*) AS e FROM ({leaves}) GROUP BY node)")
    return " UNION ALL ".join(parts)


@register("tree_depths", "WITH " + S.HOURLY_SQL + ",\n" + _tree_sql() + f"""
SELECT CAST(depth AS BIGINT) AS depth, CAST(n AS BIGINT) AS n, mse FROM ({_depth_sql()})
""")
def tree_depths(spark, sf_dir):
    """Mean squared error of the trees of depth 1 to 3, all read off one tree."""
    hd, tree = _tree(spark, sf_dir)
    for depth in range(1, DEPTH + 1):
        hd = tree.predict(hd, out=f"p{depth}", depth=depth)
    errors = F.array(*[F.pow(F.col(f"p{k}") - F.col("label"), 2) for k in range(1, DEPTH + 1)])
    return (hd.select(F.posexplode(errors).alias("place", "e")).groupBy("place")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("e"), 6).alias("mse"))
            .select((F.col("place") + 1).cast("long").alias("depth"), "n", "mse"))
