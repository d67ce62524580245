"""Numeric expressions with the missing-value rules stated once.

NaN and infinities never leave this layer: ingest turns them into NULL, and
division by zero is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tablewright.functions.text import without_separators


def finite(c: Column) -> Column:
    """NULL for NaN and both infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def to_double(c: Column) -> Column:
    """Coercive numeric cast: anything that is not a finite number is NULL."""
    return finite(c.try_cast("double"))


def to_long(c: Column) -> Column:
    """Coercive cast of text such as ``42,647,492``."""
    return without_separators(c).try_cast("bigint")


def money(c: Column) -> Column:
    """``$1,234.50`` to a double."""
    return to_double(without_separators(c))


def strict_long(c: Column) -> Column:
    """Cast that fails on bad input, for columns under contract."""
    return without_separators(c).cast("bigint")


def percent_fraction(c: Column) -> Column:
    """``2.88%`` to 0.0288; other text is NULL."""
    return to_double(F.replace(F.trim(c), F.lit("%"), F.lit(""))) / 100


def ratio(a: Column, b: Column) -> Column:
    """a / b, NULL on a zero divisor."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def percent_of(a: Column, b: Column) -> Column:
    return 100 * ratio(a, b)


def decade(year: Column) -> Column:
    """Floor to the decade (floors towards minus infinity, as integer division should)."""
    return (F.floor(year / 10) * 10).cast("int")


def clipped(c: Column, low: Column | float | None = None, high: Column | float | None = None) -> Column:
    """Clip that keeps NULL as NULL (greatest/least would skip it)."""
    out = c
    if low is not None:
        out = F.greatest(out, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        out = F.least(out, high if isinstance(high, Column) else F.lit(high))
    return F.when(c.isNotNull(), out)


def real_power(c: Column, exponent: float) -> Column:
    """Power whose undefined results (negative base) are NULL."""
    return finite(F.pow(c, F.lit(exponent)))


def cents(c: Column) -> Column:
    """Money as an exact decimal, so that sums do not depend on task order."""
    return c.cast("decimal(18,2)")
