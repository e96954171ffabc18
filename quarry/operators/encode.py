"""Feature encodings: category index, one-hot, flag decoding, assembly,
column summaries, standardisation, centring and row normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from .common import attach_row
from .indexing import dense_index


def category_index(df: DataFrame, cat: str, index_col: str = "category_index") -> DataFrame:
    """Distinct categories -> 0..k-1 in sorted order (scales past one task)."""
    return dense_index(df.select(cat), cat, index_col)


def one_hot_string(idx: Column, k: Column) -> Column:
    """0/1 indicator of length k as text (``"0,0,1"``), for printing and checks."""
    return F.array_join(F.transform(F.sequence(F.lit(0), k - 1),
                                    lambda i: F.when(i == idx, F.lit("1")).otherwise(F.lit("0"))), ",")


def one_hot_array(idx: Column, k: Column) -> Column:
    """Dense 0.0/1.0 indicator of length k (``dropLast=False``)."""
    return F.transform(F.sequence(F.lit(0), k - 1),
                       lambda i: F.when(i == idx, F.lit(1.0)).otherwise(F.lit(0.0)))


def one_hot(df: DataFrame, key: str, cat: str) -> DataFrame:
    """(key, cat, category_index, onehot) using the sorted category index.

    The index is a join on the category value; its size is the number of
    categories, and AQE broadcasts it at runtime when it is small. A row with
    a null category keeps a null index and a null indicator.
    """
    idx = category_index(df.filter(F.col(cat).isNotNull()), cat)
    k = idx.agg(F.count(F.lit(1)).cast("int").alias("_k"))
    rows = attach_row(df.select(key, cat).join(idx, cat, "left"), k)
    return rows.select(key, cat, "category_index",
                       one_hot_string(F.col("category_index"), F.col("_k")).alias("onehot"))


def decode_flags(df: DataFrame, key: str, flags: str, names: DataFrame,
                 out_col: str = "flag_names", sep: str = "|") -> DataFrame:
    """Flag array -> sorted names of the set positions.

    ``names`` is (pos, name). The flags are exploded inside the scan stage, set
    positions joined to the names dimension, and each key's names re-collected;
    a key never holds more names than the flag array has positions. A row
    without any set flag has empty names.
    """
    setpos = df.select(key, F.posexplode(flags).alias("pos", "_v")).filter(F.col("_v") == 1)
    set_names = setpos.join(names, "pos").select(key, "name")
    return (set_names.unionByName(df.select(key, F.lit(None).cast("string").alias("name")))
            .groupBy(key).agg(F.array_join(F.array_sort(F.collect_list("name")), sep).alias(out_col)))


def feature_range(vec: str, start: int, length: int) -> Column:
    """A contiguous block of a feature vector (e.g. the numeric fields after
    the id and category fields)."""
    return V.take(F.col(vec), start, length)


def assemble(cols: list[str | Column]) -> Column:
    """Numeric columns -> ``array<double>`` feature vector."""
    return F.array(*[(F.col(c) if isinstance(c, str) else c).cast("double") for c in cols])


def column_summary(df: DataFrame, vec: str) -> DataFrame:
    """Per-position mean, min, max, sample variance and non-zero count.

    Positions are exploded in-stage and aggregated partially per task, so each
    task shuffles one row per dimension regardless of the row count.
    """
    x = df.select(F.posexplode(V.as_doubles(F.col(vec))).alias("dim", "x"))
    return x.groupBy("dim").agg(
        F.avg("x").alias("mean"), F.min("x").alias("min"), F.max("x").alias("max"),
        F.var_samp("x").alias("variance"),
        F.count(F.when(F.col("x") != 0, 1)).alias("num_nonzeros"))


def _stats_row(df: DataFrame, vec: str) -> DataFrame:
    """One row with arrays of per-dimension means and sample std deviations
    (length = dimension, independent of the number of rows)."""
    s = column_summary(df, vec)
    return s.agg(F.array_sort(F.collect_list(F.struct("dim", "mean", F.sqrt("variance").alias("std"))))
                 .alias("_st")).select(F.col("_st.mean").alias("_mean"), F.col("_st.std").alias("_std"))


def standardise(df: DataFrame, vec: str, out: str, with_mean: bool = True,
                with_std: bool = True) -> DataFrame:
    """(x - mean) / std per dimension (sample std, as the column summary).

    Dimensions with zero std map to 0.0 (as ``StandardScaler``).
    """
    rows = attach_row(df, _stats_row(df, vec))
    x = V.as_doubles(F.col(vec))

    def f(v, i):
        m = F.element_at(F.col("_mean"), i + 1) if with_mean else F.lit(0.0)
        s = F.element_at(F.col("_std"), i + 1)
        if not with_std:
            return v - m
        return F.when(s == 0, F.lit(0.0)).otherwise((v - m) / s)

    return rows.withColumn(out, F.transform(x, f)).drop("_mean", "_std")


def centre(df: DataFrame, vec: str, out: str) -> DataFrame:
    return standardise(df, vec, out, with_mean=True, with_std=False)


def l2_normalise(df: DataFrame, vec: str, out: str) -> DataFrame:
    return df.withColumn(out, V.unit(V.as_doubles(F.col(vec))))
