"""Point functions shared by every plan.  All are Column -> Column and stay in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half(x: Column, digits: int) -> Column:
    """Round as C does: scale, round half away from zero, unscale.

    Spark's own ``round(x, n)`` rounds the decimal text of the double (``round(1.005, 2) = 1.01``); the
    price rules are defined on the binary value (``1.0``), so scale first and round at 0 digits.  The rounding
    is arithmetic on the double, without the decimal text that ``round`` goes through for every value.
    """
    if digits == 0:
        return F.round(x, 0)
    scale = F.lit(float(10**digits))
    return _nearest(x * scale) / scale


def _nearest(y: Column) -> Column:
    """A double to the nearest whole one, halves away from zero; a zero is never negative."""
    even = F.rint(y)  # halves to even, so only they are mended
    return F.when(F.abs(y - even) == 0.5, y + F.signum(y) * 0.5).otherwise(even + F.lit(0.0))


def safe_div(num: Column, den: Column) -> Column:
    """Division whose zero or missing denominator gives NULL (never inf, never an ANSI error)."""
    return F.when(den != 0, num / den)


def z(x: Column) -> Column:
    """NULL to 0, for addends only: a company without bonds has a blank, not an unknown."""
    return F.coalesce(x, F.lit(0.0))


def null_if(x: Column, value: float) -> Column:
    return F.when(x != F.lit(value), x)


def all_present(*cols: Column) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])


def maximum(*cols: Column) -> Column:
    """Greatest value, NULL as soon as one argument is NULL (``greatest`` would skip it)."""
    return F.when(all_present(*cols), F.greatest(*cols))


def minimum(*cols: Column) -> Column:
    return F.when(all_present(*cols), F.least(*cols))


def where(cond: Column, a: Column, b: Column) -> Column:
    """Two-way choice; a NULL condition counts as false."""
    return F.when(cond, a).otherwise(b)


def clip(x: Column, lo: float | None = None, hi: float | None = None) -> Column:
    out = x
    if lo is not None:
        out = F.when(out < lo, F.lit(float(lo))).otherwise(out)
    if hi is not None:
        out = F.when(out > hi, F.lit(float(hi))).otherwise(out)
    return out


def log(x: Column) -> Column:
    """Natural logarithm, NULL outside its domain."""
    return F.when(x > 0, F.log(x))


def sqrt(x: Column) -> Column:
    return F.when(x >= 0, F.sqrt(x))


def sign(x: Column) -> Column:
    return F.signum(x)


def exp(x: Column) -> Column:
    return F.exp(x)


def iso_week_start(d: Column) -> Column:
    """Monday of the ISO week, a key that is unique over years."""
    return F.to_date(F.date_trunc("week", d))


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)
