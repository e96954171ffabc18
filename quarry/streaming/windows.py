"""Purchase statistics per event-time window, with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .replay import key_folders, new_run_dir, only, read_stream, run_to_end, write_by_key
from .sinks import batch_rows, create_table, store_batch, stored

_STATS = ("window_start timestamp, window_end timestamp, n_purchases long, n_users long, revenue double, "
          "top_product string, top_product_count long, batch_id long")

_SHARES = "window struct<start: timestamp, end: timestamp>, file string, n long, batch_id long"


def window_stats(purchases: DataFrame, window: str, delay: str) -> DataFrame:
    """(window_start, window_end, n_purchases, n_users, revenue, top_product,
    top_product_count) per tumbling window of ``ts``; works on a stream
    (append mode) and on a table alike.

    Distinct users and product counts are exact: a purchase counts once under
    its user and once under its product, keyed by (window, kind, key), and the
    second aggregate folds the keys of a window. So state is one row per key
    and window, dealt over all state partitions, until the watermark (the
    greatest ts less ``delay``) passes the end of the window; a row whose
    window has ended by then is dropped. Ties of the top product go to the
    smallest one; null users count as no user, null products are never on top;
    a row without ts is in no window.
    """
    marked = purchases.withColumn("ts", F.col("ts").cast("timestamp")).filter("ts is not null").withWatermark("ts", delay)
    kinds = F.explode(F.array(F.struct(F.lit("user").alias("kind"), F.col("user").cast("string").alias("key")),
                              F.struct(F.lit("product").alias("kind"), F.col("product").cast("string").alias("key"))))
    keyed = (marked.select("ts", F.col("price").cast("decimal(18,2)").alias("price"), kinds.alias("k"))
             .groupBy(F.window("ts", window).alias("window"), "k.kind", "k.key")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("revenue")))
    user, product = F.col("kind") == "user", (F.col("kind") == "product") & F.col("key").isNotNull()
    folded = keyed.groupBy("window").agg(
        F.sum(F.when(user, F.col("n"))).alias("n_purchases"), F.count(F.when(user, F.col("key"))).alias("n_users"),
        F.sum(F.when(user, F.col("revenue"))).cast("double").alias("revenue"),
        F.min(F.when(product, F.struct((-F.col("n")).alias("less"), F.col("key").alias("key")))).alias("top"))
    return folded.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                         "n_purchases", "n_users", "revenue", F.col("top.key").alias("top_product"),
                         (-F.col("top.less")).alias("top_product_count"))


def window_shares(purchases: DataFrame, window: str, delay: str) -> DataFrame:
    """(window, file, n): the rows of a file stream by tumbling window of ``ts`` and file, in append mode:
    windows come when the watermark has passed their end, without rows that were late.

    A file comes in one batch, so of its rows in a window all are late or none. State is one row per window and file.
    """
    marked = (purchases.select(F.col("ts").cast("timestamp").alias("ts"), F.col("_metadata.file_path").alias("file"))
              .filter("ts is not null").withWatermark("ts", delay))
    return marked.groupBy(F.window("ts", window).alias("window"), "file").agg(F.count(F.lit(1)).alias("n"))


def windowed_stats(spark: SparkSession, purchases: DataFrame, arrival: str, window: str, delay: str,
                   trigger: dict | None = None, run_dir: str | None = None) -> DataFrame:
    """Replay purchases in ascending order of the column ``arrival`` through
    one windowed query and return its closed windows, with the batch that closed each.

    Each value of ``arrival`` is one batch whatever its number of files: the
    query runs once per value over that value's folder and keeps its state and
    watermark in the checkpoint between runs. A row is late if its window had
    ended at the watermark of the values before its own. Windows still open at
    the end are not returned, and an empty stream gives an empty table. Rows
    are stored under their batch, so a batch that is run again replaces them.

    The stream finds what counts, the files' shares of each closed window
    (``window_shares``); users and products are counted from those rows when
    the window closes. So no state is kept for a user or a product: they are
    grouped once, by an aggregate that may spill.
    """
    run = run_dir or new_run_dir(spark, "windowed-stats")
    source = write_by_key(purchases.select("user", "product", "price", "ts", arrival), arrival, f"{run}/source")
    schema = purchases.select("user", "product", "price", "ts", arrival).schema
    sink, shares = f"{run}/sink", f"{run}/shares"
    create_table(spark, sink, _STATS)
    create_table(spark, shares, _SHARES)

    def per_batch(closed: DataFrame, batch_id: int):
        store_batch(closed.withColumn("batch_id", F.lit(batch_id)), shares)
        mine = batch_rows(spark, shares, _SHARES, batch_id).select("window", "file")
        folders = mine.select(F.regexp_replace("file", "/[^/]*$", "").alias("folder")).distinct().orderBy("folder").collect()
        if folders:   # one name per value of ``arrival`` with rows in these windows
            rows = spark.read.schema(schema).parquet(only([r["folder"] for r in folders]))
            rows = rows.select("*", F.window(F.col("ts").cast("timestamp"), window).alias("window"),
                               F.col("_metadata.file_path").alias("file"))
            done = window_stats(rows.join(mine, ["window", "file"], "left_semi"), window, delay)
            store_batch(done.withColumn("batch_id", F.lit(batch_id)), sink)

    for folder in key_folders(spark, source, schema, arrival):
        closed = window_shares(read_stream(spark, only([folder]), schema), window, delay)
        run_to_end(closed.writeStream.outputMode("append").foreachBatch(per_batch)
                   .option("checkpointLocation", f"{run}/checkpoint"), trigger)
    return stored(spark, sink, _STATS)
