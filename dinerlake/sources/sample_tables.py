"""Restaurant tables derived from the TPC-H-like sample tables.

One store per customer nation; each order line becomes a restaurant order line
and carries up to two options, a surcharge (tax) and a promotion (discount).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dinerlake.functions.numeric import line_total
from dinerlake.operators.calendar import date_dim
from dinerlake.schemas import UNIT_PRICE, columns_of

# Month, day and name of the sample holidays.
HOLIDAYS = [
    (1, 1, "New Year's Day"),
    (6, 19, "Juneteenth"),
    (7, 4, "Indep. Day"),
    (11, 11, "Veterans Day"),
    (12, 25, "Christmas"),
]
STORES = [str(nation) for nation in range(25)]
LOYAL_SEGMENTS = ["BUILDING", "HOUSEHOLD"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str, *columns: Column) -> DataFrame:
    """Chosen columns of the orders with their customer.

    The merge hint has the lines dealt out by order at every size, so that they come clustered.
    """
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(*columns).hint("merge")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their part."""
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped order lines, clustered by order; repeated (order, line) keys are kept."""
    order_date = F.to_date("o_orderdate")
    orders = _orders(
        spark, sf_dir,
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("c_nationkey").cast("string").alias("restaurant_id"),
        F.col("o_orderdate").cast("timestamp").alias("creation_time_utc"),
        F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey").cast("string"))
        .alias("user_id"),
        F.lpad(F.col("o_custkey").cast("string"), 16, "4").alias("printed_card_number"),
        F.col("c_mktsegment").isin(LOYAL_SEGMENTS).alias("loyal_segment"),
        order_date.alias("order_date"),
    )
    price = F.col("p_retailprice").cast(UNIT_PRICE)
    quantity = F.col("l_quantity").cast("int")
    lines = _lines(spark, sf_dir).select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        (F.col("l_linenumber") % 2 == 1).alias("odd_line"),
        F.col("l_linenumber").cast("string").alias("lineitem_id"),
        F.col("p_type").alias("item_category"),
        F.col("p_name").alias("item_name"),
        price.alias("item_price"),
        quantity.alias("item_quantity"),
        line_total(price, quantity).alias("order_total"),
    )
    return lines.join(orders, "order_id").select(
        F.lit("app").alias("app_name"),
        "restaurant_id",
        "creation_time_utc",
        "order_id",
        "user_id",
        "printed_card_number",
        (F.col("loyal_segment") & F.col("odd_line")).alias("is_loyalty"),
        F.lit("USD").alias("currency"),
        "lineitem_id",
        "item_category",
        "item_name",
        "item_price",
        "item_quantity",
        "order_total",
        "order_date",
        F.date_add("order_date", 1).alias("ingestion_date"),
    )


def order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of the orders in ``order_items``, one row per order that has a line."""
    with_line = _lines(spark, sf_dir).select("l_orderkey").distinct()
    orders = _orders(spark, sf_dir, F.col("o_orderkey"), F.to_date("o_orderdate").alias("order_date"))
    return orders.join(with_line, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("order_date")


def _option(name: str, group: str, price: Column) -> Column:
    return F.struct(
        F.lit(group).alias("option_group_name"),
        F.lit(name).alias("option_name"),
        price.cast(UNIT_PRICE).alias("option_price"),
        F.lit(1).alias("option_quantity"),
    )


def _with_options(lines: DataFrame, *extra: str) -> DataFrame:
    both = F.array(
        _option("surcharge", "fees", F.col("tax")), _option("promo", "offers", -F.col("discount"))
    )
    return lines.select(
        "order_id",
        "lineitem_id",
        *extra,
        F.inline(F.filter(both, lambda o: o["option_price"] != 0)),
    )


def _charged_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line keys with what is added and taken off."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("lineitem_id"),
        (F.col("l_tax").cast("decimal(4,2)") * 100).alias("tax"),
        (F.col("l_discount").cast("decimal(4,2)") * 100).alias("discount"),
    )


def options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option rows; one scan of the lines, no join."""
    return _with_options(_charged_lines(spark, sf_dir))


def options_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option rows with the ingestion date of their order, silver columns only, clustered by order."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.date_add(F.to_date("o_orderdate"), 1).alias("ingestion_date"),
    )
    lines = _charged_lines(spark, sf_dir).join(orders.hint("merge"), "order_id")
    return _with_options(lines, "ingestion_date").select(*columns_of("silver_order_items_options"))


def holidays(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(HOLIDAYS, "month int, day int, holiday_name string")


def dates(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """The date dimension over a range of order dates."""
    return date_dim(spark, start, end, holidays(spark), on=["month", "day"])


# --- raw text with faults ---------------------------------------------------

def _pick(selector: Column, *choices: Column) -> Column:
    """One of the choices by ``selector`` modulo their number."""
    return F.element_at(F.array(*choices), (selector % len(choices)).cast("int") + 1)


def _price_text(selector: Column, amount: Column) -> Column:
    plain = amount.cast(UNIT_PRICE).cast("string")
    return _pick(
        selector,
        plain,
        F.concat(F.lit("$"), plain),
        F.concat(F.lit("("), plain, F.lit(")")),
        F.concat(F.lit("−$"), plain),
        F.concat(F.lit("1,"), F.lpad(plain, 6, "0")),
        F.concat(F.lit(" "), plain, F.lit(" ")),
        plain,
        plain,
        F.lit("12abc"),
        F.lit("-"),
        F.lit(""),
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All order lines as raw text, with faults spread over them by key."""
    orders = _orders(
        spark, sf_dir, *map(F.col, ["o_orderkey", "o_custkey", "o_orderdate", "c_nationkey"]))
    joined = _lines(spark, sf_dir).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("p_partkey")
    mix = order * 7 + line
    digits = F.lpad(F.col("o_custkey").cast("string"), 16, "4")
    dashed = F.concat_ws("-", *[F.substring(digits, i, 4) for i in (1, 5, 9, 13)])
    words = ["TRUE", "t", "Yes", "y", "1", "FALSE", "f", "No", "n", "0", "maybe", ""]
    return joined.select(
        F.lit("app").alias("APP_NAME"),
        F.col("c_nationkey").cast("string").alias("RESTAURANT_ID"),
        F.when(order % 97 == 0, F.lit("not a time"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
        .alias("CREATION_TIME_UTC"),
        F.when(order % 89 != 0, order.cast("string")).alias("ORDER_ID"),
        F.col("o_custkey").cast("string").alias("USER_ID"),
        F.when(order % 2 == 0, digits).otherwise(dashed).alias("PRINTED_CARD_NUMBER"),
        _pick(mix, *[F.lit(w) for w in words]).alias("IS_LOYALTY"),
        F.lit("USD").alias("CURRENCY"),
        line.cast("string").alias("LINEITEM_ID"),
        F.when(part % 13 == 0, F.concat(F.col("p_type"), F.lit(" https://menu.example/a?b=1")))
        .when(part % 17 == 0, F.repeat(F.col("p_type"), 20))
        .when(part % 19 != 0, F.col("p_type")).alias("ITEM_CATEGORY"),
        F.when(part % 23 == 0, F.repeat(F.col("p_name"), 20))
        .otherwise(F.col("p_name")).alias("ITEM_NAME"),
        _price_text(mix, F.col("p_retailprice")).alias("ITEM_PRICE"),
        F.when(order % 101 == 0, F.lit("two"))
        .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("ITEM_QUANTITY"),
    )


def raw_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All options as raw text, with faults spread over them by key."""
    lines = table(spark, sf_dir, "lineitem")
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    mix = order * 7 + line
    tax = F.col("l_tax").cast("decimal(4,2)") * 100
    discount = F.col("l_discount").cast("decimal(4,2)") * 100

    def named(text: str) -> Column:
        return (
            F.when(order % 29 == 0, F.repeat(F.lit(text), 20))
            .when(order % 31 != 0, F.lit(text)).alias("OPTION_NAME")
        )

    rows = F.array(
        F.struct(F.lit("fees").alias("OPTION_GROUP_NAME"), named("surcharge"),
                 _price_text(mix, tax).alias("OPTION_PRICE"),
                 F.lit("1").alias("OPTION_QUANTITY")),
        F.struct(F.lit("offers").alias("OPTION_GROUP_NAME"), named("promo"),
                 _price_text(mix + 1, -discount).alias("OPTION_PRICE"),
                 F.lit("1").alias("OPTION_QUANTITY")),
    )
    return lines.select(
        order.cast("string").alias("ORDER_ID"),
        line.cast("string").alias("LINEITEM_ID"),
        F.inline(rows),
    )


def raw_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw calendar row per order, in four layouts and with bad dates."""
    orders = table(spark, sf_dir, "orders")
    day, key = F.col("o_orderdate"), F.col("o_orderkey")
    text = _pick(
        key,
        F.date_format(day, "M/d/yy"),
        F.date_format(day, "dd-MM-yyyy"),
        F.date_format(day, "M/d/yyyy"),
        F.date_format(day, "MM-dd-yyyy"),
        F.lit("bad"),
    )
    return orders.select(
        F.concat(F.lit(" "), text).alias("date_key"),
        F.when(key % 3 == 0, F.year(day).cast("string")).alias("year"),
        F.when(key % 3 == 0, F.month(day).cast("string")).alias("month"),
        F.when(key % 3 == 1, F.lit("n/a")).alias("week"),
        F.lit(None).cast("string").alias("day_of_week"),
        F.when(F.weekday(day) >= 5, "TRUE").otherwise("FALSE").alias("is_weekend"),
        F.lit("FALSE").alias("is_holiday"),
        F.lit(None).cast("string").alias("holiday_name"),
    )
