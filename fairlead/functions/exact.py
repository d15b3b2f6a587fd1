"""Sums that do not depend on the order of their terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Decimal places that a term keeps.
DIGITS = 12


def fixed_point(value: Column) -> Column:
    """A double as a decimal; NULL where it is not finite or has more than 14 digits before the point."""
    return value.try_cast(f"decimal(26, {DIGITS})")


def exact_mean(value: Column, over=None) -> Column:
    """Mean of doubles, the same bits in any order and layout; NULL without a finite value.

    Terms are added as decimals, which are exact; only the sum and the quotient
    round. ``over`` makes it a window function.
    """
    term = fixed_point(value)
    total, count = F.sum(term), F.count(term)
    if over is not None:
        total, count = total.over(over), count.over(over)
    return F.try_divide(total.cast("double"), count.cast("double"))
