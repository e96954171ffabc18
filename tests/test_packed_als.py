"""The library's ALS by packed half steps: its factors, without a shuffle of them."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import packed_als, recommend
from quarry.sources.files import discard, materialise

ROWS = [(u, i, float((u * i) % 5 + 1)) for u in range(-3, 40) for i in range(1, 31) if (u + i) % 3 and (u % 7 or i < 4)]


def tables(model):
    return [{r["id"]: np.array(r["features"]) for r in f.collect()} for f in (model.userFactors, model.itemFactors)]


@pytest.mark.parametrize("part, held", [(1 << 16, 1 << 28), (9, 5000)])
def test_factors_are_the_library_s(spark, monkeypatch, part, held):
    """Repeated rows, negative ids, rows of fewer ratings than factors; whole, and cut into many groups and parts."""
    plain = packed_als.PackedRatings
    monkeypatch.setattr(packed_als, "PackedRatings", lambda rows, n, rank: plain(rows, n, rank, part, held))
    data = spark.createDataFrame(ROWS + ROWS[::4], "user long, item long, rating double")
    settings = dict(rank=5, max_iter=2, reg=0.1)
    want, _ = recommend.fit_als(data, **settings)
    got, rows = recommend.fit_als(data, **settings, small=0)
    for a, b in zip(tables(got), tables(want)):
        assert a.keys() == b.keys() and all(np.allclose(a[k], b[k], rtol=1e-3, atol=1e-4) for k in b)
    for name in ("userFactors", "itemFactors"):
        assert getattr(got, name).schema.simpleString() == getattr(want, name).schema.simpleString()
    assert got.rank == 5 and got.transform(rows).schema == want.transform(rows).schema
    assert got.transform(rows.unionByName(rows.limit(1).withColumn("user", F.lit(999)))).count() == rows.count()


def test_a_half_step_shuffles_nothing(spark):
    """Neither ratings nor factors are dealt again in a half step, whatever the number of groups."""
    rows = spark.createDataFrame(ROWS, "user int, item int, rating float")
    start = rows.select(F.col("user").alias("id")).distinct().withColumn("features", F.array(F.lit(1.0), F.lit(0.5)))
    with packed_als.PackedRatings(rows, len(ROWS), 2, held=600) as packed:
        users = materialise(packed_als.written(start, 2), "user-factors")
        plan = packed_als.met(users, packed.cells["item"])._jdf.queryExecution().optimizedPlan().toString()
        assert "InMemoryRelation" in plan and "Join Inner" in plan
        above = plan[:plan.index("InMemoryRelation")]
        assert "Repartition" not in above.replace("Repartition 1, false", "") and "Aggregate" not in above
        items = packed.half_step(users, "item", 0.1)
        assert packed_als.by_id(items, 2).count() == 30
        folder = items.inputFiles()[0].removeprefix("file:").lstrip("/").rsplit("/", 1)[0]
        discard(items)
        assert not os.path.exists(f"/{folder}")


def test_wrong_rows_raise_as_in_the_library(spark):
    for bad in ((None, 1, 2.0), (1, None, 2.0), (1, 1, None), (1, 1, float("nan")), (1, 1, float("inf"))):
        data = spark.createDataFrame([*ROWS[:40], bad], "user long, item long, rating double")
        with pytest.raises(Exception, match="MUST NOT be"):
            recommend.fit_als(data, rank=2, max_iter=1, small=0)
    with pytest.raises(Exception, match="No ratings"):
        recommend.fit_als(spark.createDataFrame([], "user long, item long, rating double"), rank=2, max_iter=1, small=-1)


def test_files_outside_the_checkpoint_folder_stay(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/mine")
    discard(spark.read.parquet(f"{tmp_path}/mine"))
    assert spark.read.parquet(f"{tmp_path}/mine").count() == 3
