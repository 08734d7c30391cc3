"""Exact money arithmetic.

Money is decimal. A quotient is rounded half-up (away from zero) on whole decimal numbers of 38
digits, so it is exact for amounts far beyond what a double can hold.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every amount has at most four decimals: amount * UNIT is a whole number.
UNIT = 10_000
_WHOLE = "decimal(38,0)"


def _units(amount: Column) -> Column:
    return (amount.cast("decimal(28,4)") * F.lit(UNIT)).cast(_WHOLE)


def safe_ratio(numerator: Column, denominator: Column, places: int = 2, factor: int = 1) -> Column:
    """``round(factor * numerator / denominator, places)``; null when the denominator is 0."""
    n, d = _units(numerator), _units(denominator)
    # floor(|n| * step / |d| + 1/2) as a quotient of whole numbers.
    above = (F.abs(n) * F.lit(2 * factor * 10**places)).cast(_WHOLE) + F.abs(d)
    below = (F.abs(d) * F.lit(2)).cast(_WHOLE)
    whole = F.try_divide((above - above % below).cast(_WHOLE), below).cast(_WHOLE)
    signed = F.when((n < 0) != (d < 0), -whole).otherwise(whole)
    return F.when(d != 0, (signed / F.lit(10**places)).cast(f"decimal(20,{places})"))


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return safe_ratio(part, whole, places, factor=100)


def mean(column: str | Column, places: int = 2) -> Column:
    """Rounded average over the non-null values (an aggregate)."""
    c = F.col(column) if isinstance(column, str) else column
    return safe_ratio(F.sum(c), F.count(c), places)


def deviation(column: str) -> Column:
    """Sample deviation rounded half-up to four places, exactly (an aggregate; null below two values).

    Count, sum and sum of squares are whole numbers of 1/10,000 and its square, so that it does not
    matter how the rows were split. With D = n * squares - sum^2, the rounded root is the largest s for
    which (2s - 1)^2 * n * (n - 1) <= 4D; a floating-point root only says where to look.
    """
    units = _units(F.col(column)).cast("decimal(22,0)")
    n = F.count(column).cast("decimal(18,0)")
    total, squares = F.sum(units).cast(_WHOLE), F.sum((units * units).cast(_WHOLE)).cast(_WHOLE)
    spread = ((n * squares).cast(_WHOLE) - (total * total).cast(_WHOLE)).cast(_WHOLE)
    pairs = (n * (n - 1)).cast(_WHOLE)
    near = F.round(F.sqrt(spread.cast("double") / F.when(pairs > 0, pairs.cast("double")))).cast("decimal(18,0)")

    def reached(s: Column) -> Column:
        double = (s * 2 - 1).cast("decimal(19,0)")
        return (s <= 0) | (((double * double).cast(_WHOLE) * pairs).cast(_WHOLE) <= (spread * 4).cast(_WHOLE))

    rounded = F.when(reached(near + 1), near + 1).when(reached(near), near).otherwise(near - 1)
    return (rounded / UNIT).cast("decimal(18,4)")


def share_of(condition: Column, places: int = 2) -> Column:
    """Percentage of rows for which ``condition`` holds (an aggregate)."""
    return percent(F.count_if(condition), F.count(F.lit(1)), places)


def money(amount: Column, places: int = 2) -> Column:
    return F.round(amount, places)


def zero_if_null(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0))
