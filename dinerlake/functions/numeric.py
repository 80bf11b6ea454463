"""Money and ratio expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dinerlake.schemas import LINE_TOTAL, MART_MONEY, ORDER_MONEY, ROLLUP_MONEY


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero(decimal_type: str) -> Column:
    """Decimal zero: a double default would turn the whole sum into a double."""
    return F.lit(0).cast(decimal_type)


def line_total(price: Column | str, quantity: Column | str) -> Column:
    return (_col(price) * _col(quantity)).cast(LINE_TOTAL)


def extended_price() -> Column:
    """Option price times its quantity."""
    return (F.col("option_price") * F.col("option_quantity")).cast(ORDER_MONEY)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division, NULL when the denominator is zero or missing."""
    below = _col(denominator)
    return F.when(below != 0, _col(numerator).cast("double") / below.cast("double"))


def ratio_or_zero(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division, 0 unless the denominator is positive."""
    below = _col(denominator)
    return F.when(
        below > 0, _col(numerator).cast("double") / below.cast("double")
    ).otherwise(F.lit(0.0))


def change(now: Column | str, before: Column | str) -> Column:
    """Relative change from ``before`` to ``now``, NULL when ``before`` is zero."""
    return ratio(_col(now) - _col(before), before)


def money_per(total: Column | str, count: Column | str, money: str = MART_MONEY) -> Column:
    """Decimal quotient, rounded half up, NULL unless the count is positive."""
    return F.when(_col(count) > 0, (_col(total) / _col(count)).cast(money))


def mean_money(c: Column | str) -> Column:
    """Aggregate: exact decimal mean, rounded once."""
    return (F.sum(_col(c)) / F.count(_col(c))).cast(MART_MONEY)


def total_money(c: Column | str) -> Column:
    """Aggregate: money sum above the day grain."""
    return F.sum(_col(c)).cast(ROLLUP_MONEY)


def share_of(condition: Column) -> Column:
    """Aggregate: share of rows for which the condition holds, NULL counted as no."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def per_cent(c: Column | str, digits: int) -> Column:
    return F.round(_col(c) * 100, digits)
