"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_row(left: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a single-row result (a global aggregate or a
    top 1) to every row of ``left``.

    The caller guarantees one row at most: a second one raises an error, and
    without any the new columns are null. An aggregate brings the side down to
    exactly one row, so broadcasting it is safe at any scale; the left side is
    never shuffled.
    """
    held = F.struct(*[F.col(c) for c in one_row.columns])
    checked = F.when(F.count(F.lit(1)) <= 1, F.first(held)).otherwise(F.raise_error("more than one row"))
    only = one_row.agg(checked.alias("_only")).select("_only.*")
    return left.join(F.broadcast(only), F.lit(True), "left")


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Global top-k: ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject,
    a bounded per-partition heap plus a k-row merge, never a full sort."""
    return df.orderBy(*order).limit(k)


def money(c: str | Column) -> Column:
    """Money as exact decimal so sums do not depend on summation order."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("decimal(18,2)")


def rounded(c: Column, digits: int = 6) -> Column:
    return F.round(c, digits)
