"""Exact money arithmetic and repeatable rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def money(c: Column | str) -> Column:
    """A price as an exact two-place decimal, so sums do not depend on row order."""
    return F.col(c).cast(MONEY) if isinstance(c, str) else c.cast(MONEY)


def money_sum(c: Column | str) -> Column:
    """Order-independent sum of a price column, returned as double.

    Summing doubles gives a result that depends on partitioning; summing exact
    decimals and converting once does not.
    """
    return F.sum(money(c)).cast("double")


def money_total(c: Column | str) -> Column:
    """Exact decimal sum of a price column (keep it decimal when dividing later)."""
    return F.sum(money(c))


def money_ratio(total: Column, den: Column) -> Column:
    """``total / den`` rounded half-up to cents, computed on exact decimals.

    Rounding a double quotient depends on how each engine rounds binary halves;
    the decimal quotient has none, so every engine agrees.
    """
    return F.round(F.try_divide(total, den), 2).cast(MONEY)


def ratio(num: Column, den: Column, places: int = 2) -> Column:
    """``round(num / den, places)``; NULL instead of an error when ``den`` is 0."""
    return F.round(F.try_divide(num, den), places)
