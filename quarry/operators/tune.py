"""Splits, samples, parameter sweeps and hold-out evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_bucket(key: Column, buckets: int = 1000) -> Column:
    """Deterministic bucket of a key: the first 32 bits of the MD5 of its text,
    so it does not follow the key's pattern and is the same in every run,
    partitioning and engine."""
    digits = F.substring(F.md5(key.cast("string").cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("long") % F.lit(buckets)


def hash_split(df: DataFrame, key: str, test_fraction: float) -> tuple[DataFrame, DataFrame]:
    """(train, test) by keyed hash buckets: a map-only filter, no shuffle."""
    b = hash_bucket(F.col(key))
    cut = int(round(test_fraction * 1000))
    return df.filter(b >= cut), df.filter(b < cut)


def hash_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """Bernoulli-style sample without replacement, keyed and reproducible."""
    return df.filter(hash_bucket(F.col(key)) < int(round(fraction * 1000)))


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Seeded weighted split (``randomSplit``): each row lands in exactly one part."""
    return df.randomSplit(weights, seed)


def sample(df: DataFrame, with_replacement: bool, fraction: float, seed: int) -> DataFrame:
    """Seeded Bernoulli (without) or Poisson (with replacement) sample."""
    return df.sample(with_replacement, fraction, seed)


def group_mean_predictions(df: DataFrame, group: str, label: str, transform: str = "none") -> DataFrame:
    """Baseline regressor: the mean of the (transformed) label per group,
    back-transformed. (label, prediction) per row."""
    y = {"none": F.col(label), "log": F.log(F.col(label)), "sqrt": F.sqrt(F.col(label))}[transform]
    t = df.select(group, F.col(label).alias("label"), y.alias("_y"))
    m = t.groupBy(group).agg(F.avg("_y").alias("_m"))
    back = {"none": F.col("_m"), "log": F.exp(F.col("_m")), "sqrt": F.col("_m") * F.col("_m")}[transform]
    return t.join(m, group).select("label", back.alias("prediction"))
