"""Numeric functions over columns: finite values, levels, ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(c: Column) -> Column:
    """The value as a finite double, else null."""
    number = c.try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def strict_finite(c: Column, name: str) -> Column:
    """The value as a finite double; anything else fails the query."""
    return F.coalesce(finite(c), F.raise_error(F.lit(f"{name} must be a finite number")).cast("double"))


def dbfs(linear: Column, floor: float | None = None) -> Column:
    """Decibels of a linear level; null (or the floor's level) where it isn't positive."""
    if floor is not None:
        return 20 * F.log10(F.greatest(linear, F.lit(floor)))
    return F.when(linear > 0, 20 * F.log10(linear))


def linear(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 20)


def rate(units: Column, seconds: Column) -> Column:
    return F.try_divide(units.cast("double"), F.when(seconds > 0, seconds))


def clamped_ratio(part: Column, whole: Column) -> Column:
    """One less the part of the whole, held to 0..1; null without a whole."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 - F.try_divide(part, F.when(whole > 0, whole))))


def quota(count: Column, ratio: float) -> Column:
    """A share of a count, halves to the even side."""
    return F.bround(count * F.lit(float(ratio)), 0).cast("long")
