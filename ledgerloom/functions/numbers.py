"""Numeric expressions shared by jobs and comparisons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT32_MIN = -2147483648
INT32_MAX = 2147483647
HUGE = 1e14


def null_if_nan(column: Column) -> Column:
    """Null instead of NaN for a floating column."""
    return F.when(F.isnan(column), F.lit(None)).otherwise(column)


def scaled_long(column: Column, digits: int = 4) -> Column:
    """Nearest multiple of ``10**-digits`` as a whole number; text of a double is never used."""
    return F.floor(column * F.lit(float(10**digits)) + F.lit(0.5)).cast("bigint")


def whole_number_text(column: Column, digits: int = 4) -> Column:
    """Text of the nearest multiple of ``10**-digits``; NaN is null, infinities and huge values keep apart.

    Beyond ``HUGE`` the scaled number would leave 64 bits and has no such digits; the plain text is exact there.
    """
    value = F.nanvl(column.cast("double"), F.lit(None).cast("double"))
    return F.when(F.abs(value) < HUGE, scaled_long(value, digits).cast("string")).otherwise(value.cast("string"))


def ratio(numerator: Column, denominator: Column, undefined: float = 0.0) -> Column:
    """Division that yields ``undefined`` for a null or zero denominator."""
    return F.when(
        F.coalesce(denominator, F.lit(0)) == 0, F.lit(undefined)
    ).otherwise(numerator.cast("double") / denominator.cast("double"))


def clip(column: Column, low: float, high: float) -> Column:
    """``column`` limited to ``[low, high]``; null stays null."""
    return F.when(column.isNull(), F.lit(None)).otherwise(
        F.least(F.greatest(column, F.lit(low)), F.lit(high))
    )


def min_max_scaled(score: Column, low: Column, high: Column) -> Column:
    """Score scaled by a training range and clipped to [0, 1]; 0 for an empty range."""
    width = high - low
    return F.when(width <= 0, F.lit(0.0)).otherwise(clip((score - low) / width, 0.0, 1.0))
