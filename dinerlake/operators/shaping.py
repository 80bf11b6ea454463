"""Matrices, top lists and small one-row frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# More columns than this are no matrix to look at; the run fails instead of leaving some out.
MAX_COLUMNS = 2_000
NO_VALUE = "none"


def column_values(df: DataFrame, column: str) -> list[str]:
    """The distinct values of ``column`` as text, sorted; an error above ``MAX_COLUMNS``."""
    found = [row[0] for row in df.select(column).distinct().limit(MAX_COLUMNS + 1).collect()]
    if len(found) > MAX_COLUMNS:
        raise ValueError(f"{column} has more than {MAX_COLUMNS} values; make a selection first")
    return sorted(found)


def matrix(
    df: DataFrame,
    index: str,
    column: str,
    value: str,
    values: Sequence[str] | None = None,
    fill: float | None = None,
    prefix: str = "",
) -> DataFrame:
    """Mean of ``value`` by index row and one column per value of ``column``.

    ``values`` is a reader's selection; without one every value gets its column,
    a NULL that of ``NO_VALUE``.
    """
    labelled = df.withColumn(column, F.coalesce(F.col(column).cast("string"), F.lit(NO_VALUE)))
    listed = column_values(labelled, column) if values is None else [str(v) for v in values]
    wide = (
        labelled.groupBy(index).pivot(column, listed).agg(F.avg(F.col(value).cast("double")))
        if listed else labelled.select(index).distinct()
    )
    if fill is not None and listed:
        wide = wide.fillna(fill, subset=listed)
    return wide.withColumnsRenamed({v: f"{prefix}{v}" for v in listed}) if prefix else wide


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows; the order must end with a key so ties are settled."""
    return df.orderBy(*order).limit(n)


def only_stores(df: DataFrame, stores: Sequence[str] | None) -> DataFrame:
    return df if stores is None else df.filter(F.col("restaurant_id").isin(list(stores)))


def only_dates(df: DataFrame, start: object = None, end: object = None) -> DataFrame:
    """Dates from ``start`` to ``end``, both included, either may be open."""
    if start is not None:
        df = df.filter(F.col("order_date") >= F.lit(start))
    if end is not None:
        df = df.filter(F.col("order_date") <= F.lit(end))
    return df


def selection(
    df: DataFrame, stores: Sequence[str] | None = None, start: object = None, end: object = None
) -> DataFrame:
    """The store and date filter that every dashboard figure shares."""
    return only_dates(only_stores(df, stores), start, end)
