"""The seven analysis reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dinerlake.functions.numeric import money_per, total_money, zero
from dinerlake.operators.calendar import join_dates
from dinerlake.operators.shaping import top
from dinerlake.plans.views import customer_facts_latest, store_sales_latest
from dinerlake.schemas import ORDER_MONEY


def sales_per_day(g1: DataFrame) -> DataFrame:
    """All stores together."""
    return g1.groupBy("order_date").agg(total_money("gross_sales_total").alias("sales"))


def store_leaderboard(g1: DataFrame, n: int = 15) -> DataFrame:
    """Best stores on the newest day."""
    newest = store_sales_latest(g1).select(
        "restaurant_id", "gross_sales_total", "orders_count",
        money_per("gross_sales_total", "orders_count").alias("aov"),
    )
    return top(newest, n, F.desc("gross_sales_total"), F.asc("restaurant_id"))


def top_items(item_sales: DataFrame, n: int = 20) -> DataFrame:
    """Best items over all stores, from the 30-day item sales."""
    sums = item_sales.groupBy("item_name").agg(total_money("sales_30d").alias("sales_30d"))
    return top(sums, n, F.desc("sales_30d"), F.asc_nulls_last("item_name"))


def discounted_vs_full_price(orders: DataFrame) -> DataFrame:
    """Net sales of orders with and without a discount, per day."""
    net, discounted = F.col("order_net_total"), F.col("has_discount_order")
    nothing = zero(ORDER_MONEY)
    return orders.groupBy("order_date").agg(
        total_money(F.when(discounted, net).otherwise(nothing)).alias("discounted_sales"),
        total_money(F.when(discounted, nothing).otherwise(net)).alias("full_price_sales"),
    )


def loyalty_orders(g1: DataFrame) -> DataFrame:
    """Orders, sales and AOV of loyal and other orders."""
    sums = g1.agg(
        F.sum("loyalty_orders").alias("loyal_orders"),
        total_money("loyalty_sales").alias("loyal_sales"),
        F.sum("non_loyalty_orders").alias("other_orders"),
        total_money("non_loyalty_sales").alias("other_sales"),
    )
    rows = sums.selectExpr(
        "stack(2, true, loyal_orders, loyal_sales, false, other_orders, other_sales)"
        " as (is_loyalty, orders, sales)"
    )
    return rows.withColumn("avg_order_value", money_per("sales", "orders"))


def segment_revenue(g3: DataFrame) -> DataFrame:
    """Customers and lifetime revenue per segment, newest snapshot."""
    return customer_facts_latest(g3).groupBy("segment_label").agg(
        F.count(F.lit(1)).alias("customers"),
        total_money("lifetime_gross_sales").alias("revenue"),
    )


def month_weekday_sales(
    g1: DataFrame, dates: DataFrame, days: int | None = None
) -> DataFrame:
    """Sales by calendar month and weekday."""
    named = join_dates(g1, dates.select("date_key", "day_of_week"), days)
    return named.groupBy(F.month("order_date").alias("m"), "day_of_week").agg(
        total_money("gross_sales_total").alias("sales")
    )
