"""Exact decimal rounding of integer ratios.

``round(avg(x), 2)`` over doubles depends on summation order and on how each
engine rounds a binary value that sits next to a decimal half-way point. The
quantities here are all ratios of integers (sums of whole seconds, whole
tenths of a minute, counts), so they are rounded exactly in integer
arithmetic and only the final scaling touches floating point.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def int_div(a: Column, b: Column) -> Column:
    """Integer quotient of a non-negative long by a positive long."""
    return F.call_function("div", a, b)


def round_ratio(num, den, digits: int, half_even: bool = False) -> Column:
    """round(num / den, digits) for an integer ``num`` and positive ``den``.

    ``half_even=False`` rounds half away from zero (SQL ``round``);
    ``half_even=True`` rounds half to even (pandas ``round``).
    NULL when ``den`` is 0 or NULL.
    """
    num, den = _c(num).cast("long"), _c(den).cast("long")
    scale = 10 ** digits
    a = F.abs(num) * F.lit(scale)
    q = int_div(a, den)
    r = a - q * den
    if half_even:
        up = (r * 2 > den) | ((r * 2 == den) & (q % 2 == 1))
    else:
        up = r * 2 >= den
    mag = q + up.cast("long")
    signed = F.when(num < 0, -mag).otherwise(mag)
    return F.when(den > 0, signed.cast("double") / F.lit(float(scale)))


def tenths_of_minute(delay_seconds) -> Column:
    """Whole tenths of a minute in ``round(delay_seconds / 60, 1)``."""
    s = _c(delay_seconds).cast("long")
    mag = int_div(F.abs(s) * 2 + 6, F.lit(12).cast("long"))
    return F.when(s < 0, -mag).otherwise(mag)


def exact_mean(int_sum, count, scale: float = 1.0) -> Column:
    """Mean of integers as the correctly rounded double ``sum / (scale*n)``."""
    return _c(int_sum).cast("double") / (_c(count).cast("double") * F.lit(scale))
