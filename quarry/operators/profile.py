"""Profiles and summary statistics: counts, distincts, sums, group counts,
medians, histograms, frequencies, imputation and top-n reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import attach_row, money, top_k


def purchase_stats(purchases: DataFrame) -> DataFrame:
    """Purchases, distinct users, revenue and the most popular product.

    One scan feeds one global aggregate (count, exact distinct users and a
    decimal revenue sum, all partial-then-final) and one product group count
    whose top row is chosen by TakeOrderedAndProject: the driver sees one row.
    Ties on the count go to the smallest product key.
    """
    totals = purchases.agg(
        F.count(F.lit(1)).alias("n_purchases"),
        F.countDistinct("user").alias("n_users"),
        F.sum(money("price")).cast("double").alias("revenue"))
    popular = top_k(
        purchases.groupBy("product").agg(F.count(F.lit(1)).alias("top_product_count")),
        [F.desc("top_product_count"), F.asc("product")], 1,
    ).withColumnRenamed("product", "top_product")
    return attach_row(totals, popular)


def line_length_stats(docs: DataFrame, text_col: str = "text", min_len: int = 10) -> DataFrame:
    """Line count, total / average line length, and the sum of doubled lengths
    of lines longer than ``min_len`` (map -> filter -> map -> sum).

    Lines come from exploding each text on newlines inside the scan stage; the
    aggregates are partial per task, so only one row per task is shuffled.
    """
    lines = docs.select(F.explode(F.split(F.col(text_col), "\n")).alias("line"))
    ln = F.length("line").cast("long")
    return lines.agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(ln).alias("total_chars"),
        F.round(F.avg(ln), 6).alias("avg_line_length"),
        F.sum(F.when(ln > min_len, ln * 2)).alias("long_lines_doubled"),
        F.count(F.when(ln > min_len, 1)).alias("n_long_lines"))


def user_profile_counts(users: DataFrame) -> DataFrame:
    """Users and distinct occupations / zips in one pass (no rescan per stat)."""
    return users.agg(
        F.count(F.lit(1)).alias("n_users"),
        F.countDistinct("occupation").alias("n_occupations"),
        F.countDistinct("zip").alias("n_zips"))


def group_counts(df: DataFrame, key: str, count_col: str = "n") -> DataFrame:
    """Reduce-by-key count, ordered by count then key (ties are stable)."""
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
            .orderBy(F.desc(count_col), F.asc(key)))


def rating_summary(ratings: DataFrame, n_users: DataFrame, n_items: DataFrame) -> DataFrame:
    """count / min / max / mean / exact median / population std, and ratings
    per user and per item, all from one aggregate over the ratings.

    ``n_users`` and ``n_items`` are one-row counts. The exact median uses the
    counting ``percentile`` aggregate, whose buffer grows with the number of
    distinct rating values (five here), not with the number of rows.
    """
    stats = ratings.agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
        F.round(F.avg("rating"), 6).alias("mean_rating"),
        F.percentile("rating", 0.5).alias("median_rating"),
        F.round(F.stddev_pop("rating"), 6).alias("stddev_rating"))
    out = attach_row(attach_row(stats, n_users), n_items)
    return out.select(
        "n_ratings", "min_rating", "max_rating", "mean_rating", "median_rating", "stddev_rating",
        F.round(F.col("n_ratings") / F.col("n_users"), 6).alias("ratings_per_user"),
        F.round(F.col("n_ratings") / F.col("n_items"), 6).alias("ratings_per_item"))


def value_distribution(df: DataFrame, key: str) -> DataFrame:
    """Count by value and its share of the total.

    The total is a one-row aggregate attached to every group (no global
    window), so the value domain can be of any size.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return attach_row(counts, total).select(key, "n", F.round(F.col("n") / F.col("_total"), 6).alias("fraction"))


def per_key_counts(df: DataFrame, key: str, count_col: str) -> DataFrame:
    """Group then size: a count per key (map-side partial count, no group lists)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))


def density_histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Fixed-width density histogram on [min, max] with ``bins`` bins.

    Two aggregates: the global min/max (one row, attached to every row), then
    a count per bin. The maximum falls in the last bin. density = n / (N * w).
    Every bin has a row, with n = 0 if nothing falls in it. Of a constant
    column all values are in bin 0 and the densities are null; a column
    without values has no bins.
    """
    rng = df.agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count(value).alias("_N"))
    x = attach_row(df.select(value).filter(F.col(value).isNotNull()), rng)
    width = (F.col("_hi") - F.col("_lo")) / bins
    place = F.floor(F.try_divide(F.col(value) - F.col("_lo"), width))
    b = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = x.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    every = rng.filter("_N > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (every.join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
            .select("bin",
                    F.round(F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / bins, 6).alias("bin_lo"),
                    F.round(F.col("_lo") + (F.col("bin") + 1) * (F.col("_hi") - F.col("_lo")) / bins, 6).alias("bin_hi"),
                    "n", F.round(F.try_divide(F.col("n"), F.col("_N") * width), 9).alias("density")))


def impute_median(df: DataFrame, key: str, value: str, bad: Column, out_col: str) -> DataFrame:
    """Replace bad values with the exact median of the good ones.

    The good values get positions in their global order (range partitions and
    offsets, no single sorting task); the median is the mean of the one or two
    in the middle: one row, attached to every row. Nulls are no good values.
    """
    from .indexing import ordered_index
    good = df.filter(~bad & F.col(value).isNotNull()).select(key, value)
    n = good.agg(F.count(F.lit(1)).alias("_n"))
    placed = attach_row(ordered_index(good, [value, key], "_at"), n)
    middle = placed.filter((F.col("_at") == F.floor((F.col("_n") - 1) / 2)) | (F.col("_at") == F.floor(F.col("_n") / 2)))
    med = middle.agg(F.avg(value).alias("_median"))
    return (attach_row(df.select(key, value, bad.alias("_bad")), med)
            .select(key, F.when(F.col("_bad"), F.col("_median")).otherwise(F.col(value)).alias(out_col),
                    F.col("_bad").alias("was_imputed")))


def purchase_stats_by(purchases: DataFrame, key: str) -> DataFrame:
    """``purchase_stats`` per value of ``key`` (e.g. per day or per batch).

    The most popular product per key is chosen by ``row_number() = 1`` over
    (key, product) counts; the optimizer adds a partial per-key limit before
    the shuffle, so a hot key does not ship all its products.
    """
    totals = purchases.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_purchases"),
        F.countDistinct("user").alias("n_users"),
        F.sum(money("price")).cast("double").alias("revenue"))
    per_product = purchases.groupBy(key, "product").agg(F.count(F.lit(1)).alias("top_product_count"))
    w = Window.partitionBy(key).orderBy(F.desc("top_product_count"), F.asc("product"))
    top = (per_product.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") == 1)
           .select(key, F.col("product").alias("top_product"), "top_product_count"))
    return totals.join(top, key, "left")
