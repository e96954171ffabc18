"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node linked to another one; component is
    the smallest node that links reach. Direction, repeats and self links do
    not matter; an empty table gives an empty result.

    Each round is two joins with a per-node minimum, both pre-aggregated; the
    pairs of a node are never gathered. A node with very many links is a hot
    join key only, which AQE splits. The driver holds one count and one
    checksum a round, and each round is written to the shared folder, so a
    lost executor costs the current round at most.
    """
    now = materialise(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                      .filter(F.col("u") != F.col("v")).distinct(), "links")
    seen = _mark(now)
    while seen[0]:
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())
        large = materialise(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        now = materialise(small, "small-star")
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
