"""Exact rounding. Ratios are rounded half away from zero from the exact fraction,
never through a double."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import Window as W
from pyspark.sql import functions as F

WHOLE = "decimal(38,0)"
MONEY = "decimal(18,2)"


def rounded_ratio(num: Column, den: Column, scale: int, times: int = 1) -> Column:
    """``times * num / den`` to ``scale`` digits for whole numbers; NULL when ``den`` is 0."""
    num, den = num.cast(WHOLE), F.nullif(den.cast(WHOLE), F.lit(0).cast(WHOLE))
    doubled = F.abs(num) * F.lit(2 * times * 10**scale)
    units = F.call_function("div", doubled + F.abs(den), F.abs(den) * F.lit(2))
    signed = F.when((num < 0) != (den < 0), -units).otherwise(units)
    if scale == 0:
        return signed.cast("decimal(18,0)")
    return (signed.cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-scale))).cast(f"decimal(18,{scale})")


def pct(num: Column, den: Column, scale: int = 1) -> Column:
    return rounded_ratio(num, den, scale, times=100)


def cents(money: Column) -> Column:
    return (money * F.lit(100)).cast(WHOLE)


def money_pct(num: Column, den: Column, scale: int = 1) -> Column:
    return pct(cents(num), cents(den), scale)


def money_mean(total: Column, count: Column, scale: int = 2) -> Column:
    """Mean of an amount from its sum and its number of values."""
    return rounded_ratio(cents(total), count.cast(WHOLE) * F.lit(100), scale)


def money(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast(MONEY)


def sum_where(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value)).cast(MONEY)


def grand_total(column: str) -> Column:
    """Sum over all rows; only for frames already grouped down to a handful of rows."""
    return F.sum(column).over(W.partitionBy())


def one_if(condition: Column) -> Column:
    """1 / 0, with unknown counted as 0."""
    return F.coalesce(condition, F.lit(False)).cast("bigint")
