"""Table schemas of all layers, as DDL text parsed by Spark."""

from __future__ import annotations

from pyspark.sql import types as T

LINE_KEY = ["order_id", "lineitem_id"]
OPTION_KEY = ["order_id", "lineitem_id", "option_name"]

UNIT_PRICE = "decimal(10,2)"
LINE_TOTAL = "decimal(12,2)"
# Sums are wider than the published (14,2): one store or one order may hold a
# large part of a very large table.  All amounts have two decimals, so the values
# are the same; 18 digits still fit in a long.
ORDER_MONEY = "decimal(18,2)"
MART_MONEY = "decimal(18,2)"
AVERAGE_MONEY = "decimal(20,4)"
ROLLUP_MONEY = "decimal(22,2)"

MAX_CATEGORY = 64
MAX_NAME = 128

# Raw CSV files: every column is text.
RAW_ITEMS = T.StructType([T.StructField(c, T.StringType()) for c in (
    "APP_NAME", "RESTAURANT_ID", "CREATION_TIME_UTC", "ORDER_ID", "USER_ID",
    "PRINTED_CARD_NUMBER", "IS_LOYALTY", "CURRENCY", "LINEITEM_ID",
    "ITEM_CATEGORY", "ITEM_NAME", "ITEM_PRICE", "ITEM_QUANTITY")])
RAW_OPTIONS = T.StructType([T.StructField(c, T.StringType()) for c in (
    "ORDER_ID", "LINEITEM_ID", "OPTION_GROUP_NAME", "OPTION_NAME",
    "OPTION_PRICE", "OPTION_QUANTITY")])
RAW_DATES = T.StructType([T.StructField(c, T.StringType()) for c in (
    "date_key", "year", "month", "week", "day_of_week", "is_weekend",
    "is_holiday", "holiday_name")])

_ITEM_FIELDS = """app_name string, restaurant_id string, creation_time_utc timestamp,
    order_id string, user_id string, printed_card_number string, is_loyalty boolean,
    currency string, lineitem_id string, item_category string, item_name string,
    item_price decimal(10,2), item_quantity int"""
_OPTION_FIELDS = """order_id string, lineitem_id string, option_name string,
    option_price decimal(10,2), option_quantity int"""

TABLES: dict[str, str] = {
    "source_order_items": _ITEM_FIELDS,
    "source_order_items_options": """order_id string, lineitem_id string,
        option_group_name string, option_name string, option_price decimal(10,2),
        option_quantity int""",
    "source_date_dim": """date_key date, day_of_week string, week int, month string,
        year int, is_weekend boolean, is_holiday boolean, holiday_name string""",
    "bronze_order_items": _ITEM_FIELDS + ", ingestion_date string",
    "bronze_order_items_options": _OPTION_FIELDS + ", ingestion_date string",
    "bronze_date_dim": """date_key date, year int, month int, day int, week int,
        day_of_week string, is_weekend boolean, is_holiday boolean,
        holiday_name string, ingestion_date string""",
    "silver_order_items": _ITEM_FIELDS
        + ", order_total decimal(12,2), order_date date, ingestion_date date",
    "silver_order_items_options": _OPTION_FIELDS + ", ingestion_date date",
    "silver_item_locator": "order_id string, lineitem_id string, order_date date, ingestion_date date",
    "silver_option_locator": "order_id string, lineitem_id string, ingestion_date date",
    "silver_date_dim": """date_key date, year int, month int, day int, week int,
        day_of_week string, is_weekend boolean, is_holiday boolean,
        holiday_name string, ingestion_date date""",
    "gold_user_orders": """user_id string, order_date date, order_id string,
        order_gross decimal(18,2), order_items_count bigint, is_loyalty_order boolean""",
    "gold_daily_sales_by_store": """restaurant_id string, item_sales decimal(18,2),
        option_sales decimal(18,2), gross_sales_total decimal(18,2), orders_count bigint,
        items_count bigint, loyalty_sales decimal(18,2), loyalty_orders bigint,
        non_loyalty_sales decimal(18,2), non_loyalty_orders bigint, order_date date""",
    "gold_item_sales_by_day": """restaurant_id string, item_category string,
        item_name string, units_sold bigint, item_sales_only decimal(18,2),
        attached_options_sales decimal(18,2), sales_total decimal(18,2), order_date date""",
    "gold_customer_facts": """user_id string, first_order_date date, last_order_date date,
        lifetime_orders bigint, lifetime_gross_sales decimal(18,2),
        avg_order_value decimal(18,2), loyalty_orders bigint, non_loyalty_orders bigint,
        last_90d_orders_count bigint, last_90d_sales decimal(18,2),
        prev_90d_sales decimal(18,2), delta_90d_pct double, days_since_last_order int,
        avg_interorder_gap_days double, recency_score int, frequency_score int,
        monetary_score int, clv_band string, segment_label string, snapshot_date date""",
    "gold_discounts_by_day": """restaurant_id string, orders_count bigint,
        discounted_orders bigint, count_discounts bigint, discount_amount_abs decimal(18,2),
        pre_discount_sales decimal(18,2), net_sales_after_discounts decimal(18,2),
        pct_orders_discounted double, pct_sales_discounted double, order_date date""",
}

PARTITION_COLUMN: dict[str, str] = {
    "bronze_order_items": "ingestion_date",
    "bronze_order_items_options": "ingestion_date",
    "bronze_date_dim": "ingestion_date",
    "silver_order_items": "ingestion_date",
    "silver_order_items_options": "ingestion_date",
    "silver_item_locator": "ingestion_date",
    "silver_option_locator": "ingestion_date",
    "gold_user_orders": "order_date",
    "gold_daily_sales_by_store": "order_date",
    "gold_item_sales_by_day": "order_date",
    "gold_customer_facts": "snapshot_date",
    "gold_discounts_by_day": "order_date",
}


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


def columns_of(table: str) -> list[str]:
    return schema_of(table).fieldNames()
