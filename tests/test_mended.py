"""Edge cases: global positions with payload, zero divisors, rows without a match, one row at most."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions import vectors as V
from quarry.operators import encode, indexing, linear, metrics, profile, tune
from quarry.operators.common import attach_row
from quarry.operators.textops import sparse_cosine


@pytest.mark.parametrize("parts,reuse", [(8, "true"), (64, "false")])
def test_positions_with_payload(spark, parts, reuse):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = spark.range(200_000).select(F.xxhash64("id").alias("k"), (F.col("id") % 7).alias("v"), F.col("id").alias("pay"))
        n = df.count()
        got = indexing.ordered_index(df, ["k"], "at", parts)
        want = df.withColumn("want", F.row_number().over(Window.orderBy("k")) - 1).select("k", "want", "pay")
        assert got.join(want, ["k", "pay"]).filter("at = want").count() == n
        sums = indexing.running_totals(df, "k", ["v"], parts)
        total = F.sum("v").over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
        assert sums.join(df.select("k", total.alias("want")), "k").filter("cum_v = want").count() == n
        assert set(sums.columns) == {"k", "v", "pay", "cum_v"}
        dense = indexing.dense_index(df, "k", "at", parts)
        assert dense.agg(F.countDistinct("at"), F.min("at"), F.max("at")).first()[:] == (n, 0, n - 1)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_one_row_at_most(spark):
    left = spark.range(3)
    two = spark.createDataFrame([(1,), (2,)], "x int")
    with pytest.raises(Exception, match="more than one row"):
        attach_row(left, two).collect()
    assert {r.x for r in attach_row(left, two.filter("x = 1")).collect()} == {1}
    assert {r.x for r in attach_row(left, two.filter("x = 9")).collect()} == {None}


def test_zero_divisors(spark):
    v = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0]), ([1.0, 2.0], [1.0, 2.0])], "a array<double>, b array<double>")
    assert [r.c for r in v.select(V.cosine(F.col("a"), F.col("b")).alias("c")).collect()] == [None, pytest.approx(1.0)]
    q = spark.createDataFrame([("t", 0.0)], "term string, tfidf double")
    c = spark.createDataFrame([(1, "t", 0.0), (2, "u", 1.0)], "doc_id long, term string, tfidf double")
    assert {r.cosine for r in sparse_cosine(q, c, "doc_id", "tfidf").collect()} == {0.0}
    one = spark.createDataFrame([(1.0, 0.3), (1.0, 0.7)], "label double, score double")
    got = metrics.binary_areas(one, "score", "label").first()
    assert got.area_under_roc is None and got.area_under_pr == pytest.approx(1.0)
    flat = profile.density_histogram(spark.createDataFrame([(2.0,)] * 4, "x double"), "x", 5).orderBy("bin").collect()
    assert [r.n for r in flat] == [4, 0, 0, 0, 0] and {r.density for r in flat} == {None}
    gaps = profile.density_histogram(spark.createDataFrame([(0.0,), (10.0,)], "x double"), "x", 20).orderBy("bin").collect()
    assert [r.n for r in gaps] == [1] + [0] * 18 + [1]


def test_rows_without_a_match_stay(spark):
    flags = spark.createDataFrame([(1, [0, 0]), (2, [1, 0])], "k long, f array<int>")
    names = spark.createDataFrame([(0, "a"), (1, "b")], "pos int, name string")
    assert {tuple(r) for r in encode.decode_flags(flags, "k", "f", names).collect()} == {(1, ""), (2, "a")}
    cats = spark.createDataFrame([(1, "x"), (2, None)], "k long, c string")
    got = {r.k: r for r in encode.one_hot(cats, "k", "c").collect()}
    assert set(got) == {1, 2} and got[2].category_index is None


def test_buckets_do_not_follow_the_key(spark):
    hours = spark.range(0, 720).select((F.col("id") * 3600).alias("k"))
    b = hours.select(tune.hash_bucket(F.col("k")).alias("b"))
    assert b.distinct().count() > 450
    train, test = tune.hash_split(spark.range(20_000), "id", 0.3)
    assert abs(test.count() / 20_000 - 0.3) < 0.02 and train.count() + test.count() == 20_000


def test_one_gradient_at_any_width(spark):
    rows = [([None if i % 10 == 0 and j == 0 else float((i * j) % 5) for j in range(70)], float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "features array<double>, label double")
    narrow = df.select(F.slice("features", 1, 3).alias("features"), "label")
    zero = [0.0] * 70
    wide = linear.gd_fit(df, iters=1, w0=zero).weights[:3]
    assert wide == pytest.approx(linear.gd_fit(narrow, iters=1).weights)
