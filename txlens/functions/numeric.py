"""Arithmetic that is safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(a: Column, b: Column, default: float | None = None) -> Column:
    """a / b as double; ``default`` (null if not given) where b is 0."""
    a, b = a.cast("double"), b.cast("double")
    return F.when(b != 0, a / b).otherwise(F.lit(default).cast("double"))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def flag(condition: Column) -> Column:
    """Boolean to 0/1; an unknown condition stays null."""
    return condition.cast("int")


def n_unique(name: str) -> Column:
    """Distinct count in which null counts as one value."""
    has_null = F.max(F.col(name).isNull().cast("int"))
    return F.count_distinct(F.col(name)) + F.coalesce(has_null, F.lit(0))


def is_round_amount(amount: Column) -> Column:
    """1 for a whole number (multiples of 5 and 10 are whole numbers too)."""
    return flag((amount % F.lit(1.0)) == 0)


def degrees_km(lat_a: Column, lon_a: Column, lat_b: Column, lon_b: Column) -> Column:
    """Flat-earth distance: Euclidean degrees times 111 km."""
    d_lat, d_lon = lat_a - lat_b, lon_a - lon_b
    return F.sqrt(d_lat * d_lat + d_lon * d_lon) * F.lit(111.0)


def int_or_zero(text: Column) -> Column:
    """Whole number in the text; 0 when it does not parse."""
    return F.coalesce(text.try_cast("bigint"), F.lit(0))


def range_bounds(text: Column, low: float, high: float) -> Column:
    """'<a>_to_<b>' as a (low, high) struct; a part that does not parse takes its default."""
    parts = F.split(text, "_to_")
    return F.struct(
        F.coalesce(F.get(parts, F.lit(0)).try_cast("double"), F.lit(low)).alias("low"),
        F.coalesce(F.get(parts, F.lit(1)).try_cast("double"), F.lit(high)).alias("high"),
    )


def scaled_amount(amount: Column, factor: Column) -> Column:
    """Amount times a factor, kept within the payment limits 1 and 500 000."""
    return clamp(amount * factor, 1.0, 500_000.0)
