"""Keep one row per key.

``row_number() = 1`` is planned with a window group limit before the shuffle,
so a key with very many copies leaves each map task as a single row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dinerlake.schemas import LINE_KEY, OPTION_KEY

ITEM_CONTENT = [*LINE_KEY, "item_category", "item_name", "item_price", "item_quantity"]
OPTION_CONTENT = [*OPTION_KEY, "option_price", "option_quantity"]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def first_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter(
        F.col("_rn") <= n
    ).drop("_rn")


def newest_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest by ingestion date, then creation time, then all other columns.

    Keys are compared as columns, NULL with NULL, so no two different keys can
    meet; the last sort columns make the choice repeatable.
    """
    lead = [c for c in ("ingestion_date", "creation_time_utc") if c in df.columns]
    rest = [c for c in df.columns if c not in lead and c not in keys]
    order = [F.col(c).desc_nulls_last() for c in lead]
    order += [F.col(c).asc_nulls_last() for c in rest]
    return first_per_key(df, keys, order)


def dedupe_items(items: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Silver rule: one row per line content, optionally within each ``within`` value."""
    return newest_per_key(items, [*within, *ITEM_CONTENT])


def dedupe_options(options: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Silver rule: one row per option content."""
    return newest_per_key(options, [*within, *OPTION_CONTENT])


def current_items(items: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Newest version of each (order, line)."""
    return newest_per_key(items, [*within, *LINE_KEY])


def current_options(options: DataFrame) -> DataFrame:
    """Newest version of each (order, line, option name)."""
    return newest_per_key(options, OPTION_KEY)
