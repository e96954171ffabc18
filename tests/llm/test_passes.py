"""A benchmark over the broadcast bound: several passes give what one gives."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from quarry.llm import decontaminate as D
from quarry.sources.tables import load_table


def test_passes_cover_all_shards():
    assert D._passes({0: 5, 1: 5, 2: 1, 4: 20, 5: 1, 6: 9}, 10) == [[0, 1], [2], [4], [5, 6]]
    assert D._passes({}, 10) == []


def test_bound_does_not_change_hits(spark):
    docs = load_table(spark, SF_SMALL, "documents").withColumn("n_hit", F.lit("replaced"))
    bench = load_table(spark, SF_SMALL, "benchmark").select("item_id", "text")
    hot = bench.limit(1).crossJoin(spark.range(1000, 1100).withColumnRenamed("id", "other")).select(
        F.col("other").cast(bench.schema["item_id"].dataType).alias("item_id"), "text")
    bench = bench.unionByName(hot).unionByName(bench).unionByName(bench.limit(3).withColumn("item_id", F.lit(None)))
    size = bench.agg(F.sum(F.length("text"))).first()[0]
    one = D.benchmark_hits(docs, bench)
    many = D.benchmark_hits(docs, bench, shard_bytes=size // 7, pass_bytes=size // 3)
    assert many.columns == one.columns and many.dtypes == one.dtypes
    a, b = ({r.doc_id: r for r in df.collect()} for df in (one, many))
    assert a == b and any(r.contaminated for r in a.values())
    assert D.benchmark_hits(docs.limit(0), bench, pass_bytes=size // 3).count() == 0
