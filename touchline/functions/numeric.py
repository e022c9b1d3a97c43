"""Ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(20,0)"


def row_count() -> Column:
    return F.count(F.lit(1))


def exact_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """numerator / denominator of two whole numbers, rounded half away from zero; NULL over zero.

    The division runs on decimals: rounding a double would round its binary image.
    """
    quotient = F.try_divide(numerator.cast(_WIDE), denominator.cast(_WIDE))
    return F.round(quotient, digits).cast("double")


def exact_mean(value: Column, digits: int) -> Column:
    """Rounded mean of a whole-number column over its non-missing values."""
    return exact_ratio(F.sum(value), F.count(value), digits)


def exact_pct(condition: Column, digits: int = 2) -> Column:
    """Rounded percentage of all rows of the group that meet the condition."""
    return exact_ratio(F.count_if(condition) * 100, row_count(), digits)


def exact_share(condition: Column, digits: int = 4) -> Column:
    return exact_ratio(F.count_if(condition), row_count(), digits)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Unrounded double ratio, NULL over zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def pct(numerator: Column, denominator: Column) -> Column:
    return ratio(numerator, denominator) * 100


def half_even(value: Column, digits: int = 2) -> Column:
    return F.bround(value, digits)
