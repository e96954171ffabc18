"""Per-batch purchase statistics and keyed running state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profile
from .replay import key_folders, new_run_dir, only, read_stream, run_to_end, write_by_key, write_source
from .sinks import create_table, store_batch, stored

_DAYS = ("day string, n_purchases long, n_users long, revenue double, top_product string, top_product_count long, "
         "batch_time string, batch_id long")


def _run_stateful(writer, trigger: dict | None, spark: SparkSession) -> None:
    """Run a stateful query to its end. The number of state-store partitions
    is taken from the session when the query first starts and kept in its
    checkpoint; the session setting is restored right after."""
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    try:
        run_to_end(writer, trigger)
    finally:
        spark.conf.set(key, old)


def batch_stats(spark: SparkSession, purchases: DataFrame, trigger: dict | None = None,
                run_dir: str | None = None, days_per_batch: int = 7) -> DataFrame:
    """Replay purchases in batches of whole days and compute, in every batch,
    purchases, distinct users, revenue and the most popular product
    (``foreachBatch`` reusing the batch operators).

    A day is a folder of as many files as its rows need, and a batch is one
    run of the query over the folders of ``days_per_batch`` days in order, so a day
    never spans two batches and no task holds a whole day. A batch's
    statistics are grouped by day; one without rows gives one row with a null
    day and product, counts 0 and revenue 0. Each batch's rows are written under
    its ``batch_id`` with a partition overwrite, so a batch replayed after a
    failure replaces, never duplicates. Returns the sink as a batch DataFrame;
    an empty stream gives an empty one.
    """
    run = run_dir or new_run_dir(spark, "batch-stats")
    daily = purchases.withColumn("day", F.date_format("ts", "yyyy-MM-dd")).drop("ts")
    daily = daily.select(*[c for c in daily.columns if c != "day"], "day")
    src = write_by_key(daily, "day", f"{run}/source")
    sink = f"{run}/sink"
    create_table(spark, sink, _DAYS)

    def per_batch(batch: DataFrame, batch_id: int):
        store_batch(day_rows(batch).withColumn("batch_id", F.lit(batch_id)), sink)

    folders = key_folders(spark, src, daily.schema, "day")
    for i in range(0, len(folders), days_per_batch):
        stream = read_stream(spark, only(folders[i:i + days_per_batch]), daily.schema)
        run_to_end(stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", f"{run}/checkpoint"), trigger)
    return stored(spark, sink, _DAYS)


def day_rows(batch: DataFrame) -> DataFrame:
    """Statistics per day of one batch with its time; one row of zeros if the batch has no rows."""
    spark = batch.sparkSession
    stats = profile.purchase_stats_by(batch, "day").withColumn("day", F.col("day").cast("string"))
    if batch.isEmpty():
        stats = spark.createDataFrame([(None, 0, 0, 0.0, None, None)], stats.schema)
    return stats.withColumn("batch_time", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"))


def _files_per_batch(spark: SparkSession, path: str, batches: int) -> int:
    """Files per trigger that replay ``path`` in about ``batches`` batches."""
    n = len(spark.read.parquet(path).inputFiles())   # a listing, no job
    return max(1, -(-n // batches))


def user_state(spark: SparkSession, purchases: DataFrame, trigger: dict | None = None,
               run_dir: str | None = None, batches: int = 5) -> DataFrame:
    """Running (purchases, revenue) per user kept in the streaming state store
    (update mode): each batch emits only the users it changed, with their new
    totals; the sink keeps (user, totals, batch_id) and the current state is
    the latest row per user. State is kept for every user seen (no expiry).
    The final state does not depend on how the days are cut into batches.
    """
    run = run_dir or new_run_dir(spark, "user-state")
    src = write_source(purchases.select("user", "price"), f"{run}/source")
    schema = purchases.select("user", "price").schema
    sink = f"{run}/sink"
    create_table(spark, sink, fields := f"{_key(purchases)}, n_purchases long, revenue decimal(28,2), batch_id long")
    running = (read_stream(spark, src, schema, _files_per_batch(spark, src, batches))
               .groupBy("user").agg(F.count(F.lit(1)).alias("n_purchases"),
                                    F.sum(F.col("price").cast("decimal(18,2)")).alias("revenue")))

    def per_batch(batch: DataFrame, batch_id: int):
        store_batch(batch.withColumn("batch_id", F.lit(batch_id)), sink)

    _run_stateful(running.writeStream.outputMode("update").foreachBatch(per_batch)
                  .option("checkpointLocation", f"{run}/checkpoint"), trigger, spark)
    return latest_per_key(stored(spark, sink, fields), "user", "batch_id")


def _key(purchases: DataFrame) -> str:
    return f"user {purchases.schema['user'].dataType.simpleString()}"


def latest_per_key(updates: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the greatest ``order`` per key (aggregate, not a window)."""
    cols = [c for c in updates.columns if c not in (key, order)]
    latest = updates.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(order)).alias("_s"))
    return latest.select(key, *[F.col(f"_s.{c}").alias(c) for c in cols])


def user_state_custom(spark: SparkSession, purchases: DataFrame, trigger: dict | None = None,
                      run_dir: str | None = None, batches: int = 5) -> DataFrame:
    """The same running (purchases, revenue) per user, written as a custom
    state update function (``applyInPandasWithState``): each batch's rows of
    a user are folded into that user's stored (count, revenue). Use this
    form when the state update is not a built-in aggregate.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    run = run_dir or new_run_dir(spark, "user-state-custom")
    src = write_source(purchases.select("user", "price"), f"{run}/source")
    schema = purchases.select("user", "price").schema
    sink = f"{run}/sink"
    create_table(spark, sink, fields := "user long, n_purchases long, revenue_cents long, batch_id long")

    def update(key, batches, state):
        n, cents = (state.get if state.exists else (0, 0))
        for pdf in batches:
            n += len(pdf)
            cents += int((pdf["price"] * 100).round().sum())
        state.update((n, cents))
        yield pd.DataFrame({"user": [key[0]], "n_purchases": [n], "revenue_cents": [cents]})

    running = (read_stream(spark, src, schema, _files_per_batch(spark, src, batches)).select("user", "price")
               .groupBy("user").applyInPandasWithState(
                   update, "user long, n_purchases long, revenue_cents long",
                   "n long, cents long", "update", GroupStateTimeout.NoTimeout))

    def per_batch(batch: DataFrame, batch_id: int):
        store_batch(batch.withColumn("batch_id", F.lit(batch_id)), sink)

    _run_stateful(running.writeStream.outputMode("update").foreachBatch(per_batch)
                  .option("checkpointLocation", f"{run}/checkpoint"), trigger, spark)
    out = latest_per_key(stored(spark, sink, fields), "user", "batch_id")
    return out.select("user", "n_purchases", (F.col("revenue_cents") / 100).cast("decimal(18,2)").alias("revenue"))
