"""Purchase statistics golden answer, edge cases and indexing helpers."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import profile
from quarry.operators.indexing import dense_index, rank_within_group, running_totals
from quarry.sources.files import from_rows

PURCHASES = [("John", "iPhone Cover", 9.99), ("John", "Headphones", 5.49), ("Jack", "iPhone Cover", 9.99),
             ("Jill", "Samsung Galaxy Cover", 8.95), ("Bob", "iPad Cover", 5.49)]
SCHEMA = "user string, product string, price double"


def test_purchase_stats_golden(spark):
    r = profile.purchase_stats(from_rows(spark, PURCHASES, SCHEMA)).collect()[0]
    assert (r.n_purchases, r.n_users, r.revenue, r.top_product, r.top_product_count) == \
        (5, 4, 39.91, "iPhone Cover", 2)


def test_purchase_stats_empty(spark):
    r = profile.purchase_stats(from_rows(spark, [], SCHEMA)).collect()[0]
    assert (r.n_purchases, r.n_users, r.revenue, r.top_product) == (0, 0, None, None)


def test_purchase_stats_ties_go_to_smallest_product(spark):
    rows = [("a", "z", 1.0), ("b", "y", 1.0), ("c", "z", 1.0), ("d", "y", 1.0)]
    r = profile.purchase_stats(from_rows(spark, rows, SCHEMA)).collect()[0]
    assert (r.top_product, r.top_product_count) == ("y", 2)


def test_chained_average_equals_stepwise(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    r = profile.line_length_stats(df).collect()[0]
    assert abs(r.total_chars / r.n_lines - r.avg_line_length) < 1e-6


def test_group_counts_equal_count_by_value(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/customer.parquet").select(F.col("c_mktsegment").alias("k"))
    a = {r.k: r.n for r in profile.group_counts(df, "k").collect()}
    b = {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    assert a == b


def test_dense_index_is_contiguous_rank(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k")).union(
        spark.range(0, 100).select(F.lit(3).cast("long").alias("k")))
    idx = dense_index(df, "k", "i", num_partitions=7)
    got = {r.k: r.i for r in idx.collect()}
    keys = sorted(got)
    assert [got[k] for k in keys] == list(range(len(keys)))


def test_rank_within_group_with_hot_group(spark):
    # one group holds most rows; small buckets split it over many windows
    hot = spark.range(0, 3000).select(F.lit(1).alias("g"), (F.col("id") * 3).alias("o"))
    cold = spark.range(0, 50).select((F.col("id") % 5 + 2).alias("g"), F.col("id").alias("o"))
    df = hot.union(cold)
    got = rank_within_group(df, "g", "o", "r", bucket_width=64)
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy("o")))
    assert sorted(got.collect()) == sorted(want.collect())


def test_running_totals(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("o"), (F.col("id") % 3).alias("v"))
    got = running_totals(df, "o", ["v"], num_partitions=5).select("o", "cum_v")
    want = df.select("o", F.sum("v").over(Window.orderBy("o")).alias("cum_v"))
    assert sorted(got.collect()) == sorted(want.collect())
