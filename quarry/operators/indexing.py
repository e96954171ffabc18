"""Dense 0..n-1 indexes over distinct keys without a single-partition window.

A global ``row_number() over (order by k)`` moves every key into one task. At
vocabulary or catalogue scale that task is the bottleneck, so keys are instead
range-partitioned, sorted inside each partition, and given
``offset(partition) + position``; only one row per partition (its key count)
is combined in a global prefix sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import materialise


def _placed(df: DataFrame, order_cols: list[str], num_partitions: int | None) -> tuple[DataFrame, DataFrame]:
    """Rows with their range partition (_pid) and position in it (_pos), and
    the rows before each partition (_off).

    Range bounds come from a sample, so two runs of the same plan may cut
    differently. The placed rows are therefore written once, and rows and
    offsets are both read from there.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = [F.col(c) for c in order_cols]
    ranged = (df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    # monotonically_increasing_id = (partition id << 33) + position in partition
    ranged = materialise(ranged.withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33))
                         .drop("_mid"), "ranged")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: bounded by the partition count, safe to window/broadcast
    before = F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    return ranged, counts.select("_pid", F.coalesce(before, F.lit(0)).alias("_off"))


def dense_index(keys: DataFrame, key: str, index_col: str = "index",
                num_partitions: int | None = None) -> DataFrame:
    """(key, index) with index = rank of key among the distinct keys, from 0.

    ``keys`` may hold duplicates; they are removed first (partial + final
    aggregate). Deterministic: the index depends only on the key order.
    """
    ranged, offsets = _placed(keys.select(key).distinct(), [key], num_partitions)
    return (ranged.join(F.broadcast(offsets), "_pid")
            .select(key, (F.col("_off") + F.col("_pos")).alias(index_col)))


def ordered_index(df: DataFrame, order_cols: list[str], index_col: str = "index",
                  num_partitions: int | None = None) -> DataFrame:
    """All columns of ``df`` plus a 0-based position in the global order of
    ``order_cols`` (which must be unique per row), computed like
    ``dense_index``: range partitions, local positions, per-partition offsets."""
    ranged, offsets = _placed(df, order_cols, num_partitions)
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(index_col, F.col("_off") + F.col("_pos")).drop("_pid", "_pos", "_off"))


def rank_within_group(df: DataFrame, group: str, order: str, out: str = "rank_in_group",
                      bucket_width: int = 4096) -> DataFrame:
    """1-based position of each row inside its group, ordered by the integer
    column ``order`` (unique within a group), without putting a whole group in
    one task.

    Rows are bucketed by ``order // bucket_width``; a count per (group, bucket)
    gives bucket offsets (one row per bucket, so a hot group is split over
    many buckets), and the window runs per (group, bucket).
    """
    b = df.withColumn("_b", F.floor(F.col(order) / bucket_width))
    per_bucket = b.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_bn"))
    offsets = per_bucket.select(
        group, "_b",
        F.coalesce(F.sum("_bn").over(Window.partitionBy(group).orderBy("_b")
                                     .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_boff"))
    local = F.row_number().over(Window.partitionBy(group, "_b").orderBy(order))
    return (b.withColumn("_local", local).join(offsets, [group, "_b"])
            .withColumn(out, F.col("_boff") + F.col("_local"))
            .drop("_b", "_local", "_boff"))


def running_totals(df: DataFrame, order: str, value_cols: list[str],
                   num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``value_cols`` in the global order of the
    unique column ``order``: per-range-partition window sums plus the totals
    of all earlier partitions (one row per partition)."""
    ranged, _ = _placed(df, [order], num_partitions)
    w_local = Window.partitionBy("_pid").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(c).over(w_local).alias(f"_loc_{c}") for c in value_cols])
    totals = ranged.groupBy("_pid").agg(*[F.sum(c).alias(f"_tot_{c}") for c in value_cols])
    w_prev = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_tot_{c}").over(w_prev), F.lit(0)).alias(f"_off_{c}")
                                      for c in value_cols])
    out = local.join(F.broadcast(offsets), "_pid")
    for c in value_cols:
        out = out.withColumn(f"cum_{c}", F.col(f"_loc_{c}") + F.col(f"_off_{c}"))
    return out.drop("_pid", "_pos", *[f"_loc_{c}" for c in value_cols], *[f"_off_{c}" for c in value_cols])
