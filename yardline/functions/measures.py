"""Indicator arithmetic: ratios of sums, weighted means, distance to a target.

Rounding is half-up to one decimal unless said otherwise, and a zero
denominator gives NULL under ANSI mode too.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def percentage(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(F.try_divide(F.lit(100) * part, whole), digits)


def weighted_mean(weighted_sum: Column, weight_sum: Column, digits: int = 1) -> Column:
    return F.round(F.try_divide(weighted_sum, weight_sum), digits)


def met_target(value: Column, target: Column) -> Column:
    """Three-valued: NULL when there is no target."""
    return value >= target


def gap(value: Column, base: Column, digits: int = 1) -> Column:
    return F.round(value - base, digits)


def all_present(columns: Iterable[str]) -> Column:
    """No NULL in any column; as plain ``IS NOT NULL`` terms, which reach file scans."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
