"""Timestamp expressions. The session zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from txlens.functions.numeric import flag


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def parse_rfc3339(text: Column) -> Column:
    """RFC 3339 text to a millisecond timestamp; null when it does not parse."""
    return F.date_trunc("millisecond", text.try_cast("timestamp"))


def is_weekend(ts: Column) -> Column:
    """Saturday or Sunday (``weekday`` counts from Monday = 0)."""
    return flag(F.weekday(ts) >= 5)


def is_night(ts: Column) -> Column:
    """22:00 up to 05:59."""
    hour = F.hour(ts)
    return flag((hour >= 22) | (hour < 6))


def hours_since_midnight(ts: Column) -> Column:
    return (
        F.hour(ts).cast("double")
        + F.minute(ts).cast("double") / F.lit(60.0)
        + F.second(ts).cast("double") / F.lit(3600.0)
    )
