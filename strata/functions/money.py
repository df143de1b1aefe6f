"""Exact sums and means as built-in Column expressions.

Double sums depend on the order rows arrive in, which differs between runs,
executors and engines.  Amounts are summed as decimals (exact, order-free) and
only the final value becomes a double.  The number of decimals is a declared
part of a metric (``SCALE`` unless given); digits beyond it are rounded.  A group with a
value that no such decimal holds (too large, infinite or NaN) gets Spark's own ``sum``
and ``avg`` of doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 8  # decimals kept of every input
PRECISION = 28  # of one input; a sum widens it by 10 digits


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_amount(c: str | Column, scale: int = SCALE) -> Column:
    return _col(c).try_cast(f"decimal({PRECISION},{scale})")


def _total(c: Column, scale: int) -> Column:
    """The exact sum where every value fits the decimal, else Spark's own sum of doubles: amounts of
    1e20 or more are added up as they are, infinities and NaN carry over."""
    double = c.try_cast("double")
    fit = F.count(as_amount(c, scale)) == F.count(double)
    return F.when(fit, F.sum(as_amount(c, scale)).cast("double")).otherwise(F.sum(double))


def money_sum(c: str | Column, scale: int = SCALE) -> Column:
    """Exact ``sum`` as double."""
    return _total(_col(c), scale)


def money_avg(c: str | Column, scale: int = SCALE) -> Column:
    """``avg`` ignoring nulls, computed from the exact sum; null for no values."""
    return F.try_divide(_total(_col(c), scale), F.count(_col(c)))


def long_sum(c: str | Column) -> Column:
    return F.sum(_col(c).cast("long"))


def line_amount(quantity: str | Column, unit_price: str | Column, discount: str | Column, digits: int = 2) -> Column:
    """``round(quantity * unit_price * (1 - discount), digits)`` in decimal, HALF_UP.
    The factors keep six decimals, so only the amount itself is rounded."""
    q = _col(quantity).cast("decimal(14,6)")
    p = _col(unit_price).cast("decimal(14,6)")
    d = _col(discount).cast("decimal(8,6)")
    return F.round(q * p * (F.lit(1).cast("decimal(1,0)") - d), digits).cast("double")
