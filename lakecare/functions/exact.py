"""Sums and averages that do not depend on the order in which rows arrive.

Adding doubles in another order changes the last bits, which a later rounding can turn
into another cent. A retried task or another partition count must not do that, so money
and ratios are summed as decimals and divided once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Decimals kept while summing; parts of a cent add up before anything is rounded.
WIDE = 8


def _decimal(value: Column) -> Column:
    return value.cast(f"decimal(28,{WIDE})")


def exact_sum(value: Column, scale: int = 2, digits: int | None = None) -> Column:
    """Sum of a double column, rounded once at the end, half up, to ``digits`` (or ``scale``) decimals, as double."""
    return F.round(F.sum(_decimal(value)), scale if digits is None else digits).cast("double")


def exact_avg(value: Column, scale: int, digits: int | None = None, factor: int = 1) -> Column:
    """``avg(value) * factor`` over non-null values, rounded half up when ``digits`` is given.

    Both sides of the division are whole numbers, so it rounds once and a tie stays a tie.
    """
    unit = 10**scale
    units = (F.sum(_decimal(value)) * F.lit(unit * factor)).cast("double")
    average = F.try_divide(units, F.count(value) * F.lit(unit))
    return average if digits is None else F.round(average, digits)


def exact_millions(value: Column, scale: int, digits: int = 2) -> Column:
    """``round(sum(value) / 1e6, digits)``."""
    return F.round(exact_sum(value, scale) / F.lit(1e6), digits)


def share_pct(hits: Column, total: Column, digits: int) -> Column:
    """``hits / total`` in percent; null when there is nothing to divide by."""
    return F.round(F.try_divide(hits * F.lit(100), total), digits)
