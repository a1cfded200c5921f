"""Column expressions for measures: exact sums, rates, gaps and flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(value: Column) -> Column:
    """Double with NaN read as missing, since NaN would pass a NULL test and any `>=`."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


#: Room for 18 digits before the point and 10 behind; a sum of 10^10 such values still fits.
EXACT = "decimal(28,10)"


def exact(value: Column, kind: str = EXACT) -> Column:
    """The number as a decimal for exact sums; NULL if it is none or does not fit."""
    return number(value).try_cast(kind)


def units(value: Column, digits: int) -> Column:
    """The number as a whole count of 10^-digits, for exact sums."""
    return F.rint(value * F.lit(float(10**digits))).cast("long")


def rounded(value: Column, digits: int = 1) -> Column:
    """HALF_UP rounding without negative zero."""
    return F.round(value, digits) + F.lit(0.0)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """100 * part / whole as a rounded double, NULL when the whole is zero."""
    return F.round(F.try_divide(F.lit(100) * part.cast("double"), whole.cast("double")), digits)


def gap(target: Column, actual: Column) -> Column:
    """Positive while the actual value is below its target."""
    return rounded(target - actual)


def reached(target: Column, actual: Column) -> Column:
    """True or false where a target exists, otherwise NULL."""
    return F.when(target.isNotNull(), actual >= target)
