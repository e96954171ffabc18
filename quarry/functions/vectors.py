"""Dense vector expressions on ``array<double>`` columns.

Higher-order functions (``zip_with``, ``aggregate``, ``transform``) run in the
JVM; no Python is involved per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_doubles(a: Column) -> Column:
    return F.transform(a, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def sq_norm(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x)


def norm(a: Column) -> Column:
    return F.sqrt(sq_norm(a))


def sq_dist(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0),
                       lambda acc, v: acc + v)


def cosine(a: Column, b: Column) -> Column:
    """Null if one of them is a zero vector."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def scale(a: Column, s: Column) -> Column:
    return F.transform(a, lambda x: x * s)


def unit(a: Column) -> Column:
    """L2-normalised vector (zero vector stays zero)."""
    n = norm(a)
    return F.when(n == 0, a).otherwise(F.transform(a, lambda x: x / n))


def vsum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)


def take(a: Column, start: int, length: int) -> Column:
    """Positions ``start`` .. ``start + length - 1`` (0-based) of a vector."""
    return F.slice(a, start + 1, length)
