"""String parsing expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: year used when a date string carries no parsable year.
MISSING_YEAR = 1900


def year_suffix(s: Column, fallback: int = MISSING_YEAR) -> Column:
    """Last four characters as an int year, ``fallback`` when not a number."""
    return F.coalesce(F.right(s, F.lit(4)).try_cast("int"), F.lit(fallback))


def title_before_parenthesis(s: Column) -> Column:
    """Text before the first parenthesised word, trimmed; unchanged when none."""
    return F.when(s.rlike(r"\(\w+\)"),
                  F.trim(F.regexp_extract(s, r"^(.*?)\(\w+\)", 1))).otherwise(s)


def strip_quotes(s: Column) -> Column:
    return F.regexp_replace(s, '"', "")


def missing_to_zero(s: Column, marker: str = "?") -> Column:
    """Missing-value marker -> 0.0, otherwise the parsed double."""
    return F.when(s == marker, F.lit(0.0)).otherwise(s.try_cast("double"))


def parse_labelled_point(line: Column) -> tuple[Column, Column]:
    """``"y<TAB>x1,x2,..."`` -> (label double, features array<double>)."""
    parts = F.split(line, "\t", 2)
    label = parts.getItem(0).cast("double")
    feats = F.transform(F.split(parts.getItem(1), ","), lambda x: x.cast("double"))
    return label, feats


def format_labelled_point(label: Column, features: Column) -> Column:
    """Inverse of ``parse_labelled_point`` (full precision text)."""
    return F.concat(label.cast("string"), F.lit("\t"),
                    F.array_join(F.transform(features, lambda x: x.cast("string")), ","))
