"""Hand-made restaurant rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from dinerlake.schemas import TABLES

D = Decimal


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def line(order, item, date="2024-01-10", store="1", user="u1", price="10.00", qty=1,
         loyal=False, category="Drinks", name="Tea", ingested=None):
    when = dt.datetime.combine(day(date), dt.time(12, 30))
    return (
        "app", store, when, order, user, "XXXX", loyal, "USD", item, category, name,
        D(price), qty, D(price) * qty, day(date), day(ingested or date),
    )


def option(order, item, name="milk", price="1.00", qty=1, ingested="2024-01-10"):
    return (order, item, name, D(price), qty, day(ingested))


def items(spark, *rows):
    return spark.createDataFrame(list(rows), TABLES["silver_order_items"])


def options(spark, *rows):
    return spark.createDataFrame(list(rows), TABLES["silver_order_items_options"])


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted(tuple(r) for r in picked.collect())


def mart(spark, table, *dicts):
    """Mart rows from partial dicts; missing columns are NULL."""
    from dinerlake.schemas import schema_of

    schema = schema_of(table)
    return spark.createDataFrame(
        [tuple(d.get(c) for c in schema.fieldNames()) for d in dicts], schema
    )
