"""Date dimension over any range, with holidays from a table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dinerlake.functions.dates import calendar_columns

# A date dimension above this many rows is joined without a broadcast hint.
BROADCAST_DAYS = 200_000


def days_between(start: dt.date, end: dt.date) -> int:
    return (end - start).days + 1


def calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day from ``start`` to ``end`` with its calendar attributes."""
    days = spark.range(max(days_between(start, end), 0)).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("date_key")
    )
    return days.select("date_key", *calendar_columns())


def with_holidays(days: DataFrame, holidays: DataFrame, on: Sequence[str]) -> DataFrame:
    """Add is_holiday and holiday_name; ``on`` is ["date_key"] or ["month", "day"].

    When several holidays share a day the first name is kept, so that the
    dimension stays unique per date.
    """
    named = holidays.groupBy(*on).agg(F.min("holiday_name").alias("holiday_name"))
    return days.join(named, list(on), "left").withColumn(
        "is_holiday", F.col("holiday_name").isNotNull()
    )


def date_dim(
    spark: SparkSession,
    start: dt.date,
    end: dt.date,
    holidays: DataFrame,
    on: Sequence[str] = ("date_key",),
) -> DataFrame:
    """Silver date dimension; ``ingestion_date`` is the day itself."""
    return with_holidays(calendar(spark, start, end), holidays, on).select(
        "date_key", "year", "month", "day", "week", "day_of_week", "is_weekend",
        "is_holiday", "holiday_name", F.col("date_key").alias("ingestion_date"),
    )


def join_dates(facts: DataFrame, dates: DataFrame, days: int | None = None) -> DataFrame:
    """Facts with the calendar columns of their order_date; a day without a calendar row
    is an error, for its sales would be lost.

    ``days`` is the known number of calendar rows; only a checked small
    calendar is broadcast, else Spark chooses from run-time sizes.
    """
    side = dates.withColumnRenamed("date_key", "order_date").withColumn("_listed", F.lit(True))
    if days is not None and days <= BROADCAST_DAYS:
        side = F.broadcast(side)
    missing = F.raise_error(F.concat(F.lit("no calendar row for "), F.col("order_date").cast("string")))
    listed = F.when(F.col("_listed").isNull() & F.col("order_date").isNotNull(),
                    missing.cast("boolean")).otherwise(F.col("_listed").isNotNull())
    return facts.join(side, "order_date", "left").where(listed).drop("_listed")


def upsert_dates(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of ``new`` replace rows of ``existing`` with the same date_key."""
    kept = existing.join(new.select("date_key"), "date_key", "left_anti")
    return kept.unionByName(new)
