"""Where the versions of a line lie.

Silver is partitioned by ingestion date, but a day run starts from lines and order dates.  Two narrow tables
say which ingestion partitions hold a line and which hold its options; they are looked up first, and of
silver only those partitions are read.  They follow silver by themselves: a partition of silver that is
newer than its index, or not in it, is indexed anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dinerlake.operators.joins import keep_matching
from dinerlake.schemas import LINE_KEY, PARTITION_COLUMN, columns_of
from dinerlake.session import cut_lineage
from dinerlake.sources import files
from dinerlake.sources.lakehouse import Lakehouse

INDEX = {
    "silver_order_items": "silver_item_locator",
    "silver_order_items_options": "silver_option_locator",
}


def refresh(lake: Lakehouse) -> None:
    """Bring the index up to silver, partition by partition."""
    for table, index in INDEX.items():
        column = PARTITION_COLUMN[table]
        have = files.partition_times(lake.spark, lake.path(table), column)
        known = files.partition_times(lake.spark, lake.path(index), column)
        stale = [day for day, (_, newest) in have.items() if day not in known or known[day][0] < newest]
        if stale:
            rows = parts(lake, table, stale).select(*columns_of(index)).distinct()
            lake.replace_partitions(index, rows, stale)
        files.drop_partitions(
            lake.spark, lake.path(index), column, [day for day in known if day not in have])


def parts(lake: Lakehouse, table: str, days: Sequence[object]) -> DataFrame:
    """The rows of these ingestion partitions; no other is listed for the scan."""
    chosen = [str(d) for d in days]
    column = F.col(PARTITION_COLUMN[table])
    return lake.read(table).filter(column.isin([F.lit(d).cast("date") for d in chosen]) if chosen else F.lit(False))


def days_holding(lake: Lakehouse, index: str, keys: DataFrame) -> list:
    """The ingestion dates at which any of these lines came; one value per day of the calendar."""
    found = lake.find(index)
    if found is None:
        return []
    held = keep_matching(found, keys, LINE_KEY).select("ingestion_date").distinct()
    return sorted(r[0] for r in held.collect())


def order_dates(lake: Lakehouse, keys: DataFrame) -> DataFrame:
    """The order dates of all versions of these lines."""
    return keep_matching(lake.read("silver_item_locator"), keys, LINE_KEY).select("order_date").distinct()


def lines_of_dates(lake: Lakehouse, touched: Sequence[object]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """All versions of the lines that ever had one of these order dates: their keys, rows and options.

    The index is read, and of silver the partitions that hold a version.
    """
    located = lake.read("silver_item_locator").filter(F.col("order_date").isin(list(touched)))
    keys = cut_lineage(located.select(*LINE_KEY).distinct())
    items = parts(lake, "silver_order_items", days_holding(lake, "silver_item_locator", keys))
    options = parts(
        lake, "silver_order_items_options", days_holding(lake, "silver_option_locator", keys))
    return keys, items, options
