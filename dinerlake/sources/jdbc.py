"""JDBC source and sink.

A single JDBC connection does not scale, so a read takes bounds on a column and
is split into ranges; the date filter is a half-open range on the bare timestamp
column, which a database can answer from an index.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

FETCH_SIZE = 10_000
BATCH_SIZE = 2_000

ITEM_COLUMNS = [
    "app_name", "restaurant_id", "creation_time_utc", "order_id", "user_id",
    "printed_card_number", "is_loyalty", "currency", "lineitem_id",
    "item_category", "item_name", "item_price", "item_quantity",
]
OPTION_COLUMNS = [
    "order_id", "lineitem_id", "option_name", "option_price", "option_quantity",
]


@dataclass(frozen=True)
class JdbcDatabase:
    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "com.microsoft.sqlserver.jdbc.SQLServerDriver"

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
        }


@dataclass(frozen=True)
class Ranges:
    """How to split a read: a numeric, date or timestamp column and its bounds."""

    column: str
    lower: str
    upper: str
    parts: int


def sub_select(sql: str, alias: str = "k") -> str:
    """A query in the place of a table name."""
    return f"({sql}) {alias}"


def day_ranges(start: dt.date, end: dt.date, parts: int = 24) -> Ranges:
    """Split the days from ``start`` to ``end`` by creation time."""
    return Ranges(
        "creation_time_utc",
        f"{start:%Y-%m-%d} 00:00:00",
        f"{end + dt.timedelta(days=1):%Y-%m-%d} 00:00:00",
        parts,
    )


def read_options(
    db: JdbcDatabase, sql: str, ranges: Ranges | None = None
) -> dict[str, str]:
    chosen = db.options() | {"fetchsize": str(FETCH_SIZE)}
    if ranges is None:
        return chosen | {"query": sql}
    return chosen | {
        "dbtable": sub_select(sql),
        "partitionColumn": ranges.column,
        "lowerBound": ranges.lower,
        "upperBound": ranges.upper,
        "numPartitions": str(ranges.parts),
    }


def write_options(db: JdbcDatabase, table: str) -> dict[str, str]:
    return db.options() | {"dbtable": table, "batchsize": str(BATCH_SIZE)}


def read_query(
    spark: SparkSession, db: JdbcDatabase, sql: str, ranges: Ranges | None = None
) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(db, sql, ranges)).load()


def append(df: DataFrame, db: JdbcDatabase, table: str) -> None:
    df.write.format("jdbc").options(**write_options(db, table)).mode("append").save()


def _in_days(start: dt.date, end: dt.date, column: str) -> str:
    after = end + dt.timedelta(days=1)
    return f"{column} >= '{start:%Y-%m-%d}' AND {column} < '{after:%Y-%m-%d}'"


def items_query(start: dt.date, end: dt.date) -> str:
    """Order lines created on the given days."""
    return (
        f"SELECT {', '.join(ITEM_COLUMNS)} FROM dbo.order_items "
        f"WHERE {_in_days(start, end, 'creation_time_utc')}"
    )


def options_query(start: dt.date, end: dt.date) -> str:
    """Options of the orders that have a line on the given days."""
    chosen = ", ".join(f"o.{c}" for c in OPTION_COLUMNS)
    return (
        f"SELECT {chosen} FROM dbo.order_items_options AS o WHERE EXISTS ("
        "SELECT 1 FROM dbo.order_items AS i WHERE i.order_id = o.order_id "
        f"AND {_in_days(start, end, 'i.creation_time_utc')})"
    )


def parent_keys_query() -> str:
    return "SELECT order_id, lineitem_id FROM dbo.order_items"
