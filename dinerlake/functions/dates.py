"""Calendar expressions and rolling-window predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "month")


def weekday_name(c: Column | str) -> Column:
    return F.date_format(_col(c), "EEEE")


def month_name(c: Column | str) -> Column:
    return F.date_format(_col(c), "MMMM")


def weekday_number(name: Column | str) -> Column:
    """1 for Monday to 7 for Sunday, to sort weekday names."""
    return F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), _col(name)).cast("int")


def is_weekend(c: Column | str) -> Column:
    return F.weekday(_col(c)) >= 5


def calendar_columns(date_col: str = "date_key") -> list[Column]:
    d = F.col(date_col)
    return [
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.weekofyear(d).alias("week"),
        weekday_name(d).alias("day_of_week"),
        is_weekend(d).alias("is_weekend"),
    ]


def latest(df: DataFrame, date_col: str = "order_date") -> Column:
    """Newest date of a table as a scalar subquery, so filters prune at run time."""
    return df.agg(F.max(date_col)).scalar()


def last_days(df: DataFrame, days: int, date_col: str = "order_date") -> Column:
    """``days`` calendar days up to and including the table's newest date."""
    newest = latest(df, date_col)
    return F.col(date_col).between(F.date_sub(newest, days - 1), newest)


def last_12_months(df: DataFrame, date_col: str = "order_date") -> Column:
    """From eleven months before the newest date (mid-month) up to that date."""
    newest = latest(df, date_col)
    return F.col(date_col).between(F.add_months(newest, -11), newest)


def shift_days(ts: Column | str, days: Column | int) -> Column:
    """Move a timestamp by whole days and keep its time of day."""
    count = F.lit(days) if isinstance(days, int) else days
    return _col(ts) + F.make_dt_interval(count, F.lit(0), F.lit(0), F.lit(0))
