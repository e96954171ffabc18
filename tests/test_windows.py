"""Event-time windows, timed triggers, keyed replays and empty streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from quarry.session import scratch_path
from quarry.streaming import online, replay, sinks, stats, windows

SCHEMA = "user long, product string, price double, ts timestamp, arrival int"


def purchases(spark, parts=1):
    """Four arrivals of days; some rows come one or two arrivals late, some have nulls."""
    rows = []
    for i in range(400):
        day = i // 10
        arrival = day // 10 + (i % 13 == 0) + (i % 29 == 0)
        ts = None if i % 97 == 5 else dt.datetime(2024, 1, 1) + dt.timedelta(days=day, minutes=i)
        rows.append((None if i % 31 == 7 else i % 7, None if i % 41 == 3 else f"p{i % 5}", i / 4.0, ts, arrival))
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def expected(rows, days, delay):
    """Plain replay: a row is dropped if its window had ended at the mark of the arrivals before."""
    epoch, mark, held = dt.datetime(1970, 1, 1), None, {}
    for arrival in sorted({r["arrival"] for r in rows}):
        new = [r for r in rows if r["arrival"] == arrival and r["ts"]]
        for r in new:
            start = epoch + dt.timedelta(days=(r["ts"] - epoch).days // days * days)
            if mark is None or start + dt.timedelta(days=days) > mark:
                held.setdefault(start, []).append(r)
        newest = max([r["ts"] for r in new], default=None)
        if newest:
            mark = max(mark or newest, newest - dt.timedelta(days=delay)) if mark else newest - dt.timedelta(days=delay)
    out = {}
    for start, got in held.items():
        if start + dt.timedelta(days=days) <= mark:
            count = {}
            for r in got:
                if r["product"] is not None:
                    count[r["product"]] = count.get(r["product"], 0) + 1
            top = min(count.items(), key=lambda x: (-x[1], x[0]))
            out[start] = (len(got), len({r["user"] for r in got if r["user"] is not None}),
                          round(sum(r["price"] for r in got), 2), *top)
    return out


@pytest.mark.parametrize("parts,trigger", [(1, None), (5, None), (2, {"processingTime": "100 milliseconds"})])
def test_windows_equal_plain_replay(spark, parts, trigger):
    p = purchases(spark, parts)
    out = windows.windowed_stats(spark, p, "arrival", "3 days", "2 days", trigger).collect()
    got = {r["window_start"]: (r["n_purchases"], r["n_users"], round(r["revenue"], 2), r["top_product"], r["top_product_count"])
           for r in out}
    want = expected([r.asDict() for r in p.collect()], 3, 2)
    assert got == want and len(out) == len(got)
    everything = windows.window_stats(p, "3 days", "2 days")   # the same plan over a table: no row is late
    assert everything.agg(F.sum("n_purchases")).first()[0] == p.filter("ts is not null").count() > sum(v[0] for v in want.values())


def test_state_has_no_rows_of_users_or_products(spark):
    """State is one row per window and file while a window is open; its users and products are counted when it closes."""
    rows = [(i, f"p{i}", 1.0, dt.datetime(2024, 1, 1 + i % 20), i % 20 // 10) for i in range(600)]
    p, run = spark.createDataFrame(rows, SCHEMA), replay.new_run_dir(spark, "small-state")
    out = windows.windowed_stats(spark, p, "arrival", "10 days", "1 day", run_dir=run)
    assert {r["window_start"]: (r["n_purchases"], r["n_users"], r["top_product"]) for r in out.collect()} == {
        k: (v[0], v[1], v[3]) for k, v in expected([r.asDict() for r in p.collect()], 10, 1).items()} != {}
    operators = [r["operatorId"] for r in spark.read.format("state-metadata").load(f"{run}/checkpoint").collect()]
    held = sum(spark.read.format("statestore").option("operatorId", k).load(f"{run}/checkpoint").count() for k in operators)
    assert 0 < held <= 20


def test_large_keys_are_split(spark):
    """A key that holds most rows is written by several tasks, a small one by one."""
    path = replay.new_run_dir(spark, "split")
    df = spark.range(0, 60_000, 1, 4).select(F.when(F.col("id") < 50_000, 1).otherwise(2).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "400k")
    try:
        replay.write_by_key(df, "k", path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old or "64MB")
    rows = spark.read.schema("k int, v string").parquet(path)
    files = {r["k"]: (r["f"], r["n"]) for r in rows.select("k", F.input_file_name().alias("file")).groupBy("k").agg(
        F.countDistinct("file").alias("f"), F.count(F.lit(1)).alias("n")).collect()}
    assert files[1][1] == 50_000 and files[2][1] == 10_000 and files[1][0] > 3
    assert [f.rsplit("=")[-1] for f in replay.key_folders(spark, path, df.schema, "k")] == ["1", "2"]


def test_numeric_and_null_keys_come_in_order(spark):
    path = replay.new_run_dir(spark, "order")
    df = spark.createDataFrame([(10, 1), (9, 2), (None, 3), (100, 4)], "k int, v int")
    replay.write_by_key(df, "k", path)
    folders = replay.key_folders(spark, path, df.schema, "k")
    assert [spark.read.schema(df.schema).parquet(f).first()["k"] for f in folders] == [None, 9, 10, 100]


def test_empty_streams(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert windows.windowed_stats(spark, none, "arrival", "1 day", "1 day").count() == 0
    assert stats.batch_stats(spark, none.drop("arrival")).count() == 0
    assert stats.user_state(spark, none).count() == 0
    assert stats.user_state_custom(spark, none).count() == 0
    points = spark.createDataFrame([], "step int, features array<double>, label double")
    weights, metrics = online.online_regression(spark, points, "step", 2, {"m": 0.1})
    assert weights.count() == 0 and metrics.count() == 0
    assert weights.columns == ["model_id", "weights", "batch_id"]


def test_empty_batch_has_a_row(spark):
    none = spark.createDataFrame([], "user long, product string, price double, day string")
    row = stats.day_rows(none).first()
    assert (row["day"], row["n_purchases"], row["n_users"], row["revenue"], row["top_product"]) == (None, 0, 0, 0.0, None)
    assert row["batch_time"]


def test_days_of_a_batch(spark):
    """Days are whole whatever the number of days in a batch, and every batch has its time."""
    p = purchases(spark, 3).drop("arrival").filter("ts is not null")
    want = None
    for days in (1, 7, 100):
        out = stats.batch_stats(spark, p, days_per_batch=days)
        rows = sorted((r["day"], r["n_purchases"], r["n_users"], r["revenue"], r["top_product"]) for r in out.collect())
        assert want in (None, rows) and out.filter("batch_time is null").isEmpty()
        want = rows
        assert out.select("batch_id").distinct().count() == -(-len(rows) // days)


def test_sinks(spark, capfd):
    path = scratch_path(spark, "sink-source")
    spark.range(5).select(F.col("id").alias("v")).write.mode("overwrite").parquet(path)
    rows = sinks.to_memory(replay.read_stream(spark, path, "v long"))
    assert sorted(r["v"] for r in rows.collect()) == list(range(5))
    replay.run_to_end(sinks.printed(replay.read_stream(spark, path, "v long").withColumn("shown", F.lit("printed-row"))))
    table = scratch_path(spark, "sink-table")
    sinks.create_table(spark, table, "v long, batch_id long")
    for _ in range(2):   # a batch that comes again
        sinks.store_batch(spark.range(3).select(F.col("id").alias("v"), F.lit(4).cast("long").alias("batch_id")), table)
    assert sinks.stored(spark, table, "v long, batch_id long").count() == 3
