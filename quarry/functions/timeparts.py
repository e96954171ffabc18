"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_seconds(ts: Column) -> Column:
    """Seconds since the epoch of a (possibly NTZ) timestamp, read as UTC."""
    return F.unix_timestamp(ts.cast("timestamp"))


def hour_of_epoch(seconds: Column) -> Column:
    """Hour of day of an epoch-seconds value (session time zone, UTC)."""
    return F.hour(F.timestamp_seconds(seconds))


def time_of_day(hour: Column) -> Column:
    """Hour -> bucket. Morning 7-11, lunch 12-13,
    afternoon 14-17, evening 18-22, night 23 and 0-6."""
    return (F.when((hour >= 7) & (hour <= 11), "morning")
            .when((hour >= 12) & (hour <= 13), "lunch")
            .when((hour >= 14) & (hour <= 17), "afternoon")
            .when((hour >= 18) & (hour <= 22), "evening")
            .otherwise("night"))
