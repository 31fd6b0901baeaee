"""Exact decimal arithmetic with the warehouse's rounding, and null-strict extremes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def divide(x: Column, y: Column, scale: int) -> Column:
    """x / y rounded half-up to `scale` digits; null when y is zero."""
    return (x / F.nullif(y, F.lit(0))).cast(f"decimal(38,{scale})")


def ratio_pct(part: Column, whole: Column, scale: int = 2) -> Column:
    """part / whole in percent for decimals of scale 2 (quotient kept to 8 digits)."""
    return F.round(divide(part, whole, 8) * 100, scale)


def share_pct(count: Column, total: Column, scale: int = 2) -> Column:
    """count * 100 / total for integer counts (quotient kept to 7 digits)."""
    return F.round(divide(count.cast("decimal(20,0)") * 100, total.cast("decimal(18,0)"), 7), scale)


def mean(total: Column, n: Column, scale: int) -> Column:
    """total / n to `scale` digits, from an exact sum and a count."""
    return divide(total, n.cast("decimal(18,0)"), scale)


def greatest_strict(*cols: Column) -> Column:
    """greatest() that is null when any argument is."""
    return _strict(F.greatest(*cols), cols)


def least_strict(*cols: Column) -> Column:
    return _strict(F.least(*cols), cols)


def _strict(value: Column, cols: tuple[Column, ...]) -> Column:
    known = cols[0].isNotNull()
    for c in cols[1:]:
        known = known & c.isNotNull()
    return F.when(known, value)


def sum_when(cond: Column, value: Column) -> Column:
    """Sum of value over the rows that meet cond, zero when there is none."""
    return F.sum(F.when(cond, value).otherwise(F.lit(0).cast("decimal(18,2)")))


def flag(cond: Column) -> Column:
    """1 where cond holds, else 0 (also where it is unknown)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def annuity_emi(principal: Column, annual_rate_pct: Column, months: Column) -> Column:
    """Monthly instalment that pays `principal` off in `months`, compounded monthly."""
    r = annual_rate_pct.cast("double") / 12 / 100
    growth = F.pow(1 + r, months)
    amount = principal.cast("double") * r * growth / F.nullif(growth - 1, F.lit(0.0))
    return F.round(amount, 2).cast("decimal(18,2)")
