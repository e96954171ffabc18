"""Streaming plans: each replays data derived from the tables through a
Structured Streaming query to completion and returns the sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.parsing import format_labelled_point, parse_labelled_point
from ..sources import Tables
from ..streaming import online, replay, sinks, stats, windows
from .catalog import register

# The two online models (step sizes) compared on one stream.
ONLINE_MODELS = {"model_1": 0.01, "model_2": 1.0}

_P = """
p AS (SELECT user_id AS "user", json_extract_string(props, '$.k') AS product, value AS price,
             strftime(ts, '%Y-%m-%d') AS day FROM events WHERE event_type = 'purchase')"""


@register("stream_batch_stats", "WITH " + _P.lstrip() + """,
totals AS (SELECT day, count(*) AS n_purchases, count(DISTINCT "user") AS n_users,
                  CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM p GROUP BY day),
top AS (SELECT day, product AS top_product, c AS top_product_count FROM (
          SELECT day, product, count(*) AS c,
                 row_number() OVER (PARTITION BY day ORDER BY count(*) DESC, product) AS r
          FROM p GROUP BY day, product) WHERE r = 1)
SELECT t.day, t.n_purchases, t.n_users, t.revenue, top.top_product, top.top_product_count
FROM totals t LEFT JOIN top ON t.day = top.day
""")
def stream_batch_stats(spark, sf_dir):
    out = stats.batch_stats(spark, Tables(spark, sf_dir).purchases())
    return out.select(F.col("day").cast("string").alias("day"), "n_purchases", "n_users", "revenue",
                      "top_product", "top_product_count")


@register("stream_user_state", "WITH " + _P.lstrip() + """
SELECT "user", count(*) AS n_purchases, CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM p GROUP BY "user"
""")
def stream_user_state(spark, sf_dir):
    out = stats.user_state(spark, Tables(spark, sf_dir).purchases())
    return out.select("user", "n_purchases", F.col("revenue").cast("double").alias("revenue"))


def regression_points(t):
    """Labelled vectors from lineitem, ordered by ship year (one batch each)."""
    li = t.lineitem
    return li.select(
        F.year("l_shipdate").alias("ship_year"),
        F.array((F.col("l_quantity") / 50.0), (F.col("l_discount") * 10.0), (F.col("l_tax") * 10.0))
        .alias("features"),
        (F.col("l_extendedprice") / 10000.0).alias("label"))


def _online_sql() -> str:
    """Batches = ship years in order. Each model takes one gradient step per
    batch from per-batch sufficient statistics (X'X, X'y, n), in a recursive
    CTE; MSE is scored on the batch rows with the previous batch's weights."""
    a = ", ".join(f"sum(x{i} * x{j}) AS a{i}{j}" for i in range(3) for j in range(3))
    c = ", ".join(f"sum(x{j} * y) AS c{j}" for j in range(3))
    upd = ", ".join(
        f"r.w{j} - r.step * ((" + " + ".join(f"r.w{k} * s.a{k}{j}" for k in range(3)) + f") - s.c{j}) / s.n"
        for j in range(3))
    base = " UNION ALL ".join(f"SELECT -1 AS b, '{m}' AS m, {step}::DOUBLE AS step, 0.0::DOUBLE AS w0, "
                              f"0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2" for m, step in ONLINE_MODELS.items())
    return f"""
WITH RECURSIVE
pts AS (SELECT year(l_shipdate) AS yr, l_quantity / 50.0 AS x0, l_discount * 10.0 AS x1, l_tax * 10.0 AS x2,
               l_extendedprice / 10000.0 AS y FROM lineitem),
yrs AS (SELECT yr, CAST(row_number() OVER (ORDER BY yr) - 1 AS BIGINT) AS b FROM (SELECT DISTINCT yr FROM pts)),
st AS (SELECT yrs.b, count(*) AS n, {a}, {c} FROM pts JOIN yrs ON pts.yr = yrs.yr
       GROUP BY yrs.b),
rec AS ({base}
        UNION ALL
        SELECT s.b, r.m, r.step, {upd} FROM rec r JOIN st s ON s.b = r.b + 1),
prev AS (SELECT b + 1 AS b, m, w0, w1, w2 FROM rec),
mon AS (SELECT prev.m AS model_id, yrs.b AS batch_id, count(*) AS n,
               avg((prev.w0 * x0 + prev.w1 * x1 + prev.w2 * x2 - y) * (prev.w0 * x0 + prev.w1 * x1 + prev.w2 * x2 - y)) AS mse
        FROM pts JOIN yrs ON pts.yr = yrs.yr JOIN prev ON prev.b = yrs.b GROUP BY prev.m, yrs.b)"""


@register("stream_regression", _online_sql() + """
SELECT m AS model_id, CAST(b AS BIGINT) AS batch_id, j, round(CASE j WHEN 0 THEN w0 WHEN 1 THEN w1 ELSE w2 END, 6) AS weight
FROM rec, (SELECT unnest([0, 1, 2]) AS j) WHERE b >= 0
""")
def stream_regression(spark, sf_dir):
    weights, _ = online.online_regression(spark, regression_points(Tables(spark, sf_dir)), "ship_year", 3,
                                          ONLINE_MODELS)
    return weights.select("model_id", "batch_id", F.posexplode("weights").alias("j", "weight")) \
        .select("model_id", "batch_id", "j", F.round("weight", 6).alias("weight"))


@register("stream_model_monitor", _online_sql() + """
SELECT model_id, batch_id, n, round(mse, 6) AS mse, round(sqrt(mse), 6) AS rmse FROM mon
""")
def stream_model_monitor(spark, sf_dir):
    _, metrics = online.online_regression(spark, regression_points(Tables(spark, sf_dir)), "ship_year", 3,
                                          ONLINE_MODELS)
    return metrics.select("model_id", "batch_id", "n", F.round("mse", 6).alias("mse"),
                          F.round("rmse", 6).alias("rmse"))


#: Fixed values of the windowed replay: tumbling windows and how long rows may come late.
WINDOW_DAYS, DELAY_DAYS = 30, 20


def shipped_purchases(t):
    """(user, product, price, ts, arrival): lines by their ship time; a line
    arrives with its ship year, a returned one with the year after."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate", "l_returnflag")
    late = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    return (li.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_custkey").alias("user"), F.col("l_partkey").cast("string").alias("product"),
                    F.col("l_extendedprice").alias("price"), F.col("l_shipdate").alias("ts"),
                    (F.year("l_shipdate") + late).alias("arrival")))


@register("stream_window_stats", f"""
WITH p AS (SELECT o_custkey AS "user", CAST(l_partkey AS VARCHAR) AS product, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
                  l_shipdate AS ts, year(l_shipdate) + CASE l_returnflag WHEN 'R' THEN 1 ELSE 0 END AS arrival,
                  epoch(l_shipdate) - epoch(l_shipdate) % ({WINDOW_DAYS} * 86400) AS w
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
seen AS (SELECT arrival, max(max(epoch(ts))) OVER (ORDER BY arrival) - {DELAY_DAYS} * 86400 AS mark FROM p GROUP BY arrival),
marks AS (SELECT arrival, lag(mark) OVER (ORDER BY arrival) AS before FROM seen),
kept AS (SELECT p.* FROM p JOIN marks m ON m.arrival = p.arrival
         WHERE (m.before IS NULL OR w + {WINDOW_DAYS} * 86400 > m.before)
           AND w + {WINDOW_DAYS} * 86400 <= (SELECT max(mark) FROM seen)),
totals AS (SELECT w, count(*) AS n_purchases, count(DISTINCT "user") AS n_users, CAST(sum(price) AS DOUBLE) AS revenue
           FROM kept GROUP BY w),
top AS (SELECT w, product, c FROM (SELECT w, product, count(*) AS c,
               row_number() OVER (PARTITION BY w ORDER BY count(*) DESC, product) AS r FROM kept GROUP BY w, product) WHERE r = 1)
SELECT CAST(t.w AS BIGINT) AS window_start, t.n_purchases, t.n_users, t.revenue, top.product AS top_product, top.c AS top_product_count
FROM totals t JOIN top ON top.w = t.w
""")
def stream_window_stats(spark, sf_dir):
    out = windows.windowed_stats(spark, shipped_purchases(Tables(spark, sf_dir)), "arrival", f"{WINDOW_DAYS} days",
                                 f"{DELAY_DAYS} days")
    return out.select(F.unix_timestamp("window_start").alias("window_start"), "n_purchases", "n_users", "revenue",
                      "top_product", "top_product_count")


@register("stream_labelled_text", """
SELECT year(l_shipdate) AS ship_year, count(*) AS n, round(sum(l_extendedprice / 10000.0), 4) AS label_sum,
       round(sum(l_quantity / 50.0), 4) AS x0, round(sum(l_discount * 10.0), 4) AS x1, round(sum(l_tax * 10.0), 4) AS x2
FROM lineitem GROUP BY 1
""")
def stream_labelled_text(spark, sf_dir):
    """Labelled points as lines of text, streamed, parsed and summed by year (complete mode, memory sink)."""
    points = regression_points(Tables(spark, sf_dir))
    path = replay.new_run_dir(spark, "labelled-text")
    line = format_labelled_point(F.col("label"), F.concat(F.col("features"), F.array(F.col("ship_year").cast("double"))))
    points.select(line.alias("value")).write.mode("overwrite").text(path)
    label, x = parse_labelled_point(F.col("value"))
    parsed = replay.read_text_stream(spark, path, 4).select(label.alias("y"), x.alias("x"))
    sums = parsed.groupBy(F.col("x")[3].cast("int").alias("ship_year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("label_sum"), *[F.sum(F.col("x")[j]).alias(f"x{j}") for j in range(3)])
    out = sinks.to_memory(sums, "complete")
    return out.select(F.col("ship_year").cast("long").alias("ship_year"), "n", F.round("label_sum", 4).alias("label_sum"), *[F.round(f"x{j}", 4).alias(f"x{j}") for j in range(3)])
