"""Purchase statistics and data-profiling plans."""

from __future__ import annotations

from ..operators import profile
from ..sources import Tables
from .catalog import register


@register("purchase_stats", """
WITH p AS (
  SELECT user_id AS "user", json_extract_string(props, '$.k') AS product, value AS price
  FROM events WHERE event_type = 'purchase'),
totals AS (
  SELECT count(*) AS n_purchases, count(DISTINCT "user") AS n_users,
         CAST(sum(CAST(price AS DECIMAL(18,2))) AS DOUBLE) AS revenue FROM p),
top AS (
  SELECT product AS top_product, count(*) AS top_product_count FROM p
  GROUP BY product ORDER BY top_product_count DESC, product LIMIT 1)
SELECT * FROM totals LEFT JOIN top ON TRUE
""")
def purchase_stats(spark, sf_dir):
    return profile.purchase_stats(Tables(spark, sf_dir).purchases())


@register("line_length_stats", """
WITH l AS (SELECT CAST(length(line) AS BIGINT) AS ln
           FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))
SELECT count(*) AS n_lines, CAST(sum(ln) AS BIGINT) AS total_chars,
       round(avg(ln), 6) AS avg_line_length,
       CAST(sum(CASE WHEN ln > 10 THEN ln * 2 END) AS BIGINT) AS long_lines_doubled,
       count(CASE WHEN ln > 10 THEN 1 END) AS n_long_lines
FROM l
""")
def line_length_stats(spark, sf_dir):
    return profile.line_length_stats(Tables(spark, sf_dir).documents)


@register("user_profile_counts", """
SELECT count(*) AS n_users, count(DISTINCT c_mktsegment) AS n_occupations,
       count(DISTINCT c_nationkey) AS n_zips
FROM customer
""")
def user_profile_counts(spark, sf_dir):
    return profile.user_profile_counts(Tables(spark, sf_dir).users())


@register("segment_counts", """
SELECT c_mktsegment AS occupation, count(*) AS n FROM customer GROUP BY c_mktsegment
""")
def segment_counts(spark, sf_dir):
    return profile.group_counts(Tables(spark, sf_dir).users(), "occupation")


RATINGS_SQL = """
ratings AS (
  SELECT o.o_custkey AS "user", l.l_partkey AS item,
         CAST(ceil(avg(l.l_quantity) / 10) AS DOUBLE) AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_custkey, l.l_partkey)"""


@register("rating_summary", f"""
WITH {RATINGS_SQL}
SELECT count(*) AS n_ratings, min(rating) AS min_rating, max(rating) AS max_rating,
       round(avg(rating), 6) AS mean_rating, quantile_cont(rating, 0.5) AS median_rating,
       round(stddev_pop(rating), 6) AS stddev_rating,
       round(count(*) / (SELECT count(*) FROM customer), 6) AS ratings_per_user,
       round(count(*) / (SELECT count(*) FROM part), 6) AS ratings_per_item
FROM ratings
""")
def rating_summary(spark, sf_dir):
    t = Tables(spark, sf_dir)
    from pyspark.sql import functions as F
    return profile.rating_summary(
        t.ratings(),
        t.customer.agg(F.count(F.lit(1)).alias("n_users")),
        t.part.agg(F.count(F.lit(1)).alias("n_items")))


@register("rating_distribution", f"""
WITH {RATINGS_SQL}
SELECT rating, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS fraction
FROM ratings GROUP BY rating
""")
def rating_distribution(spark, sf_dir):
    return profile.value_distribution(Tables(spark, sf_dir).ratings(), "rating")


@register("ratings_per_user", f"""
WITH {RATINGS_SQL}
SELECT "user", count(*) AS n_ratings FROM ratings GROUP BY "user"
""")
def ratings_per_user(spark, sf_dir):
    return profile.per_key_counts(Tables(spark, sf_dir).ratings(), "user", "n_ratings")


@register("activity_histogram", """
WITH r AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, count(c_acctbal) AS nn FROM customer),
b AS (
  SELECT CASE WHEN (hi - lo) / 20 = 0 THEN 0
              ELSE CAST(least(floor((c_acctbal - lo) / ((hi - lo) / 20)), 19) AS INTEGER) END AS bin,
         lo, hi, nn
  FROM customer, r WHERE c_acctbal IS NOT NULL)
SELECT CAST(k.bin AS INTEGER) AS bin, round(lo + k.bin * (hi - lo) / 20, 6) AS bin_lo,
       round(lo + (k.bin + 1) * (hi - lo) / 20, 6) AS bin_hi,
       coalesce(c.n, 0) AS n, round(coalesce(c.n, 0) / (nn * ((hi - lo) / 20)), 9) AS density
FROM range(20) k(bin) CROSS JOIN r LEFT JOIN (SELECT bin, count(*) AS n FROM b GROUP BY bin) c ON c.bin = k.bin
""")
def activity_histogram(spark, sf_dir):
    return profile.density_histogram(Tables(spark, sf_dir).users(), "balance", 20)


@register("target_histograms", """
WITH hd AS (SELECT CAST(count(*) AS DOUBLE) AS cnt FROM events GROUP BY date_trunc('hour', ts)),
t AS (SELECT 'none' AS transform, cnt AS v FROM hd UNION ALL SELECT 'log', ln(cnt) FROM hd UNION ALL SELECT 'sqrt', sqrt(cnt) FROM hd),
r AS (SELECT transform, min(v) AS lo, max(v) AS hi, count(*) AS nn FROM t GROUP BY transform),
b AS (SELECT t.transform, CASE WHEN (hi - lo) / 12 = 0 THEN 0 ELSE CAST(least(floor((v - lo) / ((hi - lo) / 12)), 11) AS INTEGER) END AS bin
      FROM t JOIN r ON r.transform = t.transform),
c AS (SELECT transform, bin, count(*) AS n FROM b GROUP BY transform, bin)
SELECT r.transform, CAST(k.bin AS INTEGER) AS bin, round(lo + k.bin * (hi - lo) / 12, 6) AS bin_lo,
       round(lo + (k.bin + 1) * (hi - lo) / 12, 6) AS bin_hi, coalesce(c.n, 0) AS n,
       round(coalesce(c.n, 0) / (nn * ((hi - lo) / 12)), 9) AS density
FROM range(12) k(bin) CROSS JOIN r LEFT JOIN c ON c.bin = k.bin AND c.transform = r.transform
""")
def target_histograms(spark, sf_dir):
    """Density histograms of hourly demand and of its logarithm and square root."""
    from pyspark.sql import functions as F
    hd = Tables(spark, sf_dir).hourly_demand()
    outs = [profile.density_histogram(hd.select(f("cnt").alias("v")), "v", 12).select(F.lit(name).alias("transform"), "*")
            for name, f in (("none", F.col), ("log", F.log), ("sqrt", F.sqrt))]
    return outs[0].unionByName(outs[1]).unionByName(outs[2])


@register("release_age_counts", """
WITH y AS (
  SELECT coalesce(TRY_CAST(right(strftime(o_orderdate, '%d-%b-%Y'), 4) AS INTEGER), 1900) AS yr FROM orders)
SELECT 1998 - yr AS age, count(*) AS n FROM y WHERE yr <> 1900 GROUP BY 1998 - yr
""")
def release_age_counts(spark, sf_dir):
    from pyspark.sql import functions as F
    from ..functions.parsing import MISSING_YEAR, year_suffix
    o = Tables(spark, sf_dir).orders
    yr = o.select(year_suffix(F.date_format("o_orderdate", "dd-MMM-yyyy")).alias("yr"))
    ages = yr.filter(F.col("yr") != MISSING_YEAR).select((F.lit(1998) - F.col("yr")).alias("age"))
    return profile.per_key_counts(ages, "age", "n")


@register("url_suffix_parse", r"""
WITH p AS (
  SELECT page_id,
         TRY_CAST(regexp_extract(url, '/(\d+)', 1) AS BIGINT) AS path_number,
         regexp_extract(url, '/([a-z][a-z])/', 1) AS url_lang,
         trim(regexp_extract(html, '<title>(.*?)</title>', 1)) AS raw_title
  FROM pages)
SELECT page_id, path_number, url_lang, raw_title,
       CASE WHEN regexp_matches(raw_title, '\(\w+\)')
            THEN trim(regexp_extract(raw_title, '^(.*?)\(\w+\)', 1)) ELSE raw_title END AS title
FROM p
""")
def url_suffix_parse(spark, sf_dir):
    from pyspark.sql import functions as F
    from ..functions.parsing import title_before_parenthesis
    p = Tables(spark, sf_dir).pages
    base = p.select(
        "page_id",
        F.regexp_extract("url", r"/(\d+)", 1).try_cast("bigint").alias("path_number"),
        F.regexp_extract("url", r"/([a-z][a-z])/", 1).alias("url_lang"),
        F.trim(F.regexp_extract("html", r"<title>(.*?)</title>", 1)).alias("raw_title"))
    return base.withColumn("title", title_before_parenthesis(F.col("raw_title")))


@register("impute_median", """
WITH m AS (SELECT quantile_cont(c_acctbal, 0.5) AS med FROM customer WHERE NOT (c_acctbal < 0))
SELECT c_custkey AS "user", round(CASE WHEN c_acctbal < 0 THEN med ELSE c_acctbal END, 6) AS balance_imputed,
       c_acctbal < 0 AS was_imputed
FROM customer, m
""")
def impute_median(spark, sf_dir):
    from pyspark.sql import functions as F
    u = Tables(spark, sf_dir).users()
    out = profile.impute_median(u, "user", "balance", F.col("balance") < 0, "balance_imputed")
    return out.withColumn("balance_imputed", F.round("balance_imputed", 6))


@register("time_of_day", """
WITH h AS (SELECT CAST(hour(ts) AS INTEGER) AS hour FROM events)
SELECT hour, CASE WHEN hour BETWEEN 7 AND 11 THEN 'morning' WHEN hour BETWEEN 12 AND 13 THEN 'lunch'
                  WHEN hour BETWEEN 14 AND 17 THEN 'afternoon' WHEN hour BETWEEN 18 AND 22 THEN 'evening'
                  ELSE 'night' END AS time_of_day,
       count(*) AS n
FROM h GROUP BY hour
""")
def time_of_day(spark, sf_dir):
    from pyspark.sql import functions as F
    from ..functions.timeparts import epoch_seconds, hour_of_epoch, time_of_day as tod
    ev = Tables(spark, sf_dir).events
    h = ev.select(hour_of_epoch(epoch_seconds(F.col("ts"))).cast("int").alias("hour"))
    return h.groupBy("hour").agg(F.count(F.lit(1)).alias("n")).withColumn("time_of_day", tod(F.col("hour")))
