"""Exact sums and means of decimal readings.

A reading stands for the shortest decimal that names its double, as it was written by its sender. Most carry two decimals:
those are summed as whole numbers of hundredths, in long integers and generated code. Any other one, up to eighteen
decimals, goes into a second sum of wide decimals, which costs nothing where there are none. Both sums are exact, do not
depend on the order of partial aggregates, and make one total. Means round half up from the exact quotient.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Readings beyond this are no readings; hundredths of it fit a long integer.
LARGEST = 9e16


def usable(reading: str | Column) -> Column:
    """The reading, null where it is NaN, infinite or out of all bounds."""
    x = F.col(reading) if isinstance(reading, str) else reading
    return F.when(F.abs(x) < LARGEST, x)


def exact_sum(reading: str | Column, only: Column | None = None) -> Column:
    """Aggregate: the exact total of usable readings (of the rows ``only``) as decimal(38,18); 0 where there are none."""
    x = F.col(reading) if isinstance(reading, str) else reading
    x = usable(x.cast("double"))
    if only is not None:
        x = F.when(only, x)
    cents = F.rint(x * 100).cast("bigint")
    two = cents / 100.0 == x
    short = F.sum(F.when(two, cents))
    long = F.sum(F.when(~two, x.cast("decimal(38,18)")))
    zero = F.lit(Decimal(0))
    wide = lambda c: F.coalesce(c, zero).cast("decimal(37,18)")
    return wide(short.cast("decimal(20,0)") * F.lit(Decimal("0.01"))) + wide(long)


def mean_of(total: str, n: str, digits: int = 2) -> Column:
    """Mean of an exact total, rounded half up; null without rows."""
    return F.expr(f"cast(round(({total}) / cast(nullif({n}, 0) as decimal(20,0)), {digits}) as double)")


def exact_mean_of(total: str, n: str) -> Column:
    """Unrounded mean of an exact total; null without rows."""
    return F.expr(f"cast(({total}) as double) / nullif({n}, 0)")


def hundredths(name: str) -> Column:
    """A two-decimal reading as a whole number of hundredths; null where it is no number that fits."""
    return F.rint(F.col(name) * 100).try_cast("bigint")


def half_up_ratio(num: str, den: str, digits: int) -> Column:
    """``num / den`` rounded half away from zero to ``digits``; null when ``den`` is 0.

    ``num`` and ``den`` are SQL expressions of whole numbers. Only the remainder is scaled, so sums over very many
    rows do not overflow.
    """
    d = f"nullif(cast(({den}) as bigint), 0)"
    n = f"cast(({num}) as bigint)"
    unit = 10 ** digits
    whole = f"({unit} * (abs({n}) div {d}) + (2 * {unit} * (abs({n}) % {d}) + {d}) div (2 * {d}))"
    return F.expr(f"cast(sign({n}) as bigint) * {whole} / {unit}D")


def mean_of_hundredths(total: str, n: str, digits: int = 2) -> Column:
    """Mean of a sum of hundredths, rounded half up."""
    return half_up_ratio(total, f"({n}) * 100", digits)


def exact_mean_of_hundredths(total: str, n: str) -> Column:
    """Unrounded mean of a sum of hundredths."""
    return F.expr(f"({total}) / 100D / ({n})")
