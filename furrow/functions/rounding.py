"""Rounding of doubles by the three rules in use; each is one column expression that stays in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Splits a double into two halves whose products are exact.
SPLIT = 134217729.0
#: From here on a double has no fraction.
WHOLE = 2.0**52


def _c(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def nearest(c: str | Column, digits: int) -> Column:
    """To ``digits`` decimals by the exact binary value, true ties to even: the rule of Python's round.

    0.5105 is a little less than it looks, so three decimals give 0.510. The rounding error of the product by
    the power of ten is found exactly, and decides what lies nearest. Null, NaN and infinities stay.
    """
    x, b = _c(c), 10.0**digits
    p = x * F.lit(b)
    bh = b * SPLIT - (b * SPLIT - b)
    bl = b - bh
    big = x * F.lit(SPLIT)
    ah = big - (big - x)
    al = x - ah
    error = ((ah * F.lit(bh) - p) + ah * F.lit(bl) + al * F.lit(bh)) + al * F.lit(bl)
    low = p - F.pmod(p, F.lit(1.0))
    above = (p - low) - F.lit(0.5)
    up = (above > -error) | ((above == -error) & (F.pmod(low, F.lit(2.0)) == 1.0))
    return F.when(F.abs(p) < WHOLE, (low + up.cast("double")) / F.lit(b)).otherwise(x)


def half_even(c: str | Column, digits: int) -> Column:
    """The product by the power of ten, ties to even, divided again: the rule of NumPy and pandas."""
    return F.rint(_c(c) * F.lit(10.0**digits)) / F.lit(10.0**digits)


def half_away(c: str | Column, digits: int) -> Column:
    """The product by the power of ten, ties away from zero, divided again: the rule of SQL engines on doubles."""
    return F.round(_c(c) * F.lit(10.0**digits), 0) / F.lit(10.0**digits)


#: By name, for what takes the rule as a parameter.
RULES = {"nearest": nearest, "half_even": half_even, "half_away": half_away}
