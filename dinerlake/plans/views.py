"""Serving views over the marts.

Rolling windows end at the newest date of the mart itself, not at today.  All
ratios are true double divisions without early rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dinerlake.functions.dates import last_12_months, last_days, latest, month_start
from dinerlake.functions.numeric import (
    change, mean_money, money_per, ratio, ratio_or_zero, share_of, total_money,
)
from dinerlake.operators.calendar import join_dates
from dinerlake.operators.lines import enrich_lines, options_of_lines, orders_discount
from dinerlake.schemas import MART_MONEY, ROLLUP_MONEY

STORE_DAY = ["restaurant_id", "order_date"]


# --- daily views ------------------------------------------------------------

def sales_trends_daily(g1: DataFrame) -> DataFrame:
    """Store-day sales of the last 91 days with AOV and loyalty share."""
    recent = g1.filter(last_days(g1, 91))
    return recent.select(
        *STORE_DAY, "gross_sales_total", "orders_count", "items_count",
        ratio("gross_sales_total", "orders_count").alias("avg_order_value"),
        "loyalty_sales", "non_loyalty_sales",
        ratio_or_zero("loyalty_sales", "gross_sales_total").alias("loyalty_sales_pct"),
    )


def top_items_30d(g2: DataFrame) -> DataFrame:
    """Item sales of the last 30 days with their rank in the store.

    Equal sales are ranked by category and name.
    """
    item = ["restaurant_id", "item_category", "item_name"]
    sums = item_sales_30d(g2)
    rank = Window.partitionBy("restaurant_id").orderBy(
        F.desc("sales_30d"), F.asc_nulls_last("item_category"), F.asc_nulls_last("item_name")
    )
    return sums.select(
        *item, "units_30d", "sales_30d", F.row_number().over(rank).alias("rn_store")
    )


def loyalty_mix_daily(g1: DataFrame) -> DataFrame:
    """Loyal and other orders per store-day, last 91 days."""
    both = F.col("loyalty_orders") + F.col("non_loyalty_orders")
    return g1.filter(last_days(g1, 91)).select(
        *STORE_DAY, "loyalty_sales", "non_loyalty_sales", "loyalty_orders",
        "non_loyalty_orders",
        ratio_or_zero("loyalty_orders", both).alias("loyalty_orders_pct"),
    )


def discounts_daily(g4: DataFrame) -> DataFrame:
    """Store-day discounts of the last 91 days."""
    return g4.filter(last_days(g4, 91)).select(
        *STORE_DAY, "pre_discount_sales", "discount_amount_abs",
        "net_sales_after_discounts", "pct_orders_discounted", "pct_sales_discounted",
    )


def sales_with_holidays_daily(
    g1: DataFrame, dates: DataFrame, days: int | None = None
) -> DataFrame:
    """Store-day sales with holiday and weekend flags."""
    flags = dates.select("date_key", "is_holiday", "holiday_name", "is_weekend")
    return join_dates(g1, flags, days).select(
        *STORE_DAY, "gross_sales_total", "orders_count",
        "is_holiday", "holiday_name", "is_weekend",
    )


def store_sales_latest(g1: DataFrame) -> DataFrame:
    """All stores on the newest day (our definition: the reference only uses it)."""
    return g1.filter(F.col("order_date") == latest(g1)).withColumn(
        "avg_order_value", ratio("gross_sales_total", "orders_count")
    )


# --- customers --------------------------------------------------------------

def customer_facts_latest(g3: DataFrame) -> DataFrame:
    """Newest snapshot."""
    return g3.filter(F.col("snapshot_date") == latest(g3, "snapshot_date"))


def _latest_aliased(g3: DataFrame) -> DataFrame:
    return customer_facts_latest(g3).withColumnRenamed(
        "last_90d_orders_count", "last_90d_orders"
    )


def churn_risk_latest(g3: DataFrame) -> DataFrame:
    """Risk level per user; conditions on a missing change are simply not met."""
    days, delta = F.col("days_since_last_order"), F.col("delta_90d_pct")
    lapsed = (F.col("last_90d_orders") == 0) & (F.col("prev_90d_sales") > 0)
    high = (F.col("recency_score") <= 2) | (days > 45) | lapsed | (delta <= -0.5)
    medium = (days > 30) | (delta <= -0.25)
    return _latest_aliased(g3).select(
        "user_id", "days_since_last_order", "avg_interorder_gap_days",
        "last_90d_orders", "last_90d_sales", "prev_90d_sales", "delta_90d_pct",
        "recency_score", "frequency_score", "monetary_score",
        F.when(high, "High").when(medium, "Medium").otherwise("Low").alias("risk_level"),
    )


def customer_segments_latest(g3: DataFrame) -> DataFrame:
    """Segments with loyalty membership: any loyal order makes a member."""
    return _latest_aliased(g3).select(
        "user_id", (F.col("loyalty_orders") > 0).alias("is_loyalty_member"),
        "recency_score", "frequency_score", "monetary_score", "segment_label",
        "lifetime_gross_sales", "avg_order_value", "last_90d_orders",
        "last_90d_sales", "days_since_last_order",
    )


def loyalty_vs_nonloyalty(g3: DataFrame) -> DataFrame:
    """Members against others in the newest snapshot."""
    return (
        _latest_aliased(g3)
        .groupBy((F.col("loyalty_orders") > 0).alias("is_loyalty_member"))
        .agg(
            mean_money("lifetime_gross_sales").alias("avg_clv"),
            mean_money("avg_order_value").alias("avg_aov"),
            share_of(F.col("lifetime_orders") >= 2).alias("repeat_rate"),
            F.avg("last_90d_orders").alias("avg_orders_90d"),
            mean_money("last_90d_sales").alias("avg_sales_90d"),
        )
    )


# --- monthly and seasonal views ---------------------------------------------

def _months(mart: DataFrame, *keys: str) -> DataFrame:
    return mart.withColumn("month", month_start("order_date")).groupBy(*keys, "month")


def sales_monthly_store(g1: DataFrame) -> DataFrame:
    return _months(g1, "restaurant_id").agg(
        total_money("gross_sales_total").alias("gross_month"),
        F.sum("orders_count").alias("orders_month"),
    )


def sales_monthly_category(g2: DataFrame) -> DataFrame:
    return _months(g2, "restaurant_id", "item_category").agg(
        total_money("sales_total").alias("sales_month"),
        F.sum("units_sold").alias("units_month"),
    )


def sales_monthly_store_12m(g1: DataFrame) -> DataFrame:
    """Month sales and their change to the store's previous month."""
    months = sales_monthly_store(g1.filter(last_12_months(g1))).drop("orders_month")
    before = F.lag("gross_month").over(Window.partitionBy("restaurant_id").orderBy("month"))
    return months.withColumn("_before", before).select(
        "restaurant_id", "month", "gross_month",
        change("gross_month", "_before").alias("mom_pct"),
    )


def category_mix_monthly_12m(g2: DataFrame) -> DataFrame:
    """Category share of the store's month."""
    mix = sales_monthly_category(g2.filter(last_12_months(g2)))
    whole = F.sum("sales_month").over(Window.partitionBy("restaurant_id", "month"))
    return mix.select(
        "restaurant_id", "month", "item_category", "sales_month",
        ratio("sales_month", whole).alias("sales_share"),
    )


def sales_dow_store_12m(
    g1: DataFrame, dates: DataFrame, days: int | None = None
) -> DataFrame:
    """Mean daily sales per store and weekday."""
    recent = g1.filter(last_12_months(g1))
    named = join_dates(recent, dates.select("date_key", "day_of_week"), days)
    return named.groupBy("restaurant_id", "day_of_week").agg(
        mean_money("gross_sales_total").alias("avg_sales_dow")
    )


def holiday_uplift_12m(
    g1: DataFrame, dates: DataFrame, days: int | None = None, literal: bool = False
) -> DataFrame:
    """Holiday sales against plain days of the same weekday in the same store.

    Plain days are summed and counted per (store, weekday) before they meet the
    holidays, so each holiday day counts once.  ``literal=True`` keeps the
    published fan-out, where a holiday counts once per plain day.
    """
    wanted = dates.select("date_key", "is_holiday", "holiday_name", "day_of_week")
    base = join_dates(g1.filter(last_12_months(g1)), wanted, days)
    key = ["restaurant_id", "day_of_week"]
    plain = base.filter(~F.col("is_holiday")).groupBy(*key).agg(
        F.sum("gross_sales_total").alias("plain_sales"),
        F.count("gross_sales_total").alias("plain_days"),
    )
    weight: Column = F.col("plain_days") if literal else F.lit(1)
    sums = (
        base.filter("is_holiday")
        .join(plain, key)
        .groupBy("restaurant_id", "holiday_name")
        .agg(
            F.sum(F.col("gross_sales_total") * weight).alias("sales"),
            F.count(F.lit(1)).alias("holiday_days"),
            F.sum("plain_sales").alias("plain_sales"),
            F.sum("plain_days").alias("plain_days"),
        )
    )
    # Uplift compares means: sales per holiday day with sales per plain day.
    per_day = F.col("sales").cast("double")
    if not literal:
        per_day = per_day / F.col("holiday_days")
    return sums.select(
        "restaurant_id", "holiday_name",
        F.col("sales").cast(ROLLUP_MONEY).alias("holiday_sales"),
        money_per("plain_sales", "plain_days").alias("baseline_sales"),
        (ratio(per_day, ratio("plain_sales", "plain_days")) - 1).alias("uplift_pct"),
    )


# --- locations --------------------------------------------------------------

def location_performance_90d(g1: DataFrame, items: DataFrame) -> DataFrame:
    """Revenue, orders, customers and repeat rate per store, last 90 days.

    Lines without a user form one group, which counts in the repeat rate but not
    as a customer.
    """
    newest = latest(g1)
    window = F.col("order_date").between(F.date_sub(newest, 89), newest)
    revenue = g1.filter(window).groupBy("restaurant_id").agg(
        total_money("gross_sales_total").alias("gross_90d"),
        F.sum("orders_count").alias("orders_90d"),
    )
    users = (
        items.filter(window)
        .select("restaurant_id", "order_id", "user_id").distinct()
        .groupBy("restaurant_id", "user_id").agg(F.count("order_id").alias("user_orders"))
        .groupBy("restaurant_id").agg(
            F.count("user_id").alias("customers"),
            share_of(F.col("user_orders") >= 2).alias("repeat_rate"),
        )
    )
    return revenue.join(users, "restaurant_id", "left").select(
        "restaurant_id", "gross_90d", "orders_90d",
        money_per("gross_90d", "orders_90d").alias("aov_90d"),
        F.coalesce("customers", F.lit(0)).alias("customers_90d"),
        F.coalesce("repeat_rate", F.lit(0.0)).alias("repeat_rate_90d"),
    )


def location_actions_90d(g1: DataFrame, items: DataFrame) -> DataFrame:
    """Location performance with loyalty share, last month's change and advice.

    Our definition, from the columns its users read: advice follows plain rules
    on repeat rate, loyalty share and the last change.
    """
    loyalty = g1.filter(last_days(g1, 90)).groupBy("restaurant_id").agg(
        ratio(F.sum("loyalty_orders"), F.sum("orders_count")).alias("loyalty_order_share")
    )
    last_change = sales_monthly_store_12m(g1).groupBy("restaurant_id").agg(
        F.max_by("mom_pct", "month").alias("last_mom_pct")
    )
    joined = (
        location_performance_90d(g1, items)
        .join(loyalty, "restaurant_id", "left")
        .join(last_change, "restaurant_id", "left")
    )
    advice = F.concat_ws(
        "; ",
        F.when(F.col("repeat_rate_90d") < 0.3, "win back one-time customers"),
        F.when(F.col("loyalty_order_share") < 0.3, "promote the loyalty program"),
        F.when(F.col("last_mom_pct") < -0.05, "review the recent decline"),
    )
    return joined.withColumn("recommendations", advice)


# --- items and discounts ----------------------------------------------------

def item_sales_30d(g2: DataFrame) -> DataFrame:
    """Item sales per store over the last 30 days."""
    return g2.filter(last_days(g2, 30)).groupBy(
        "restaurant_id", "item_category", "item_name"
    ).agg(
        F.sum("units_sold").alias("units_30d"),
        total_money("sales_total").alias("sales_30d"),
    )


def discount_effectiveness_30d(g4: DataFrame) -> DataFrame:
    """Discount totals per store over the last 30 days."""
    sums = g4.filter(last_days(g4, 30)).groupBy("restaurant_id").agg(
        total_money("pre_discount_sales").alias("pre_sales_30d"),
        total_money("discount_amount_abs").alias("discount_30d"),
        total_money("net_sales_after_discounts").alias("net_sales_30d"),
        F.sum("discounted_orders").cast("double").alias("discounted_orders_30d"),
        F.sum("orders_count").cast("double").alias("orders_30d"),
    )
    return sums.withColumn(
        "pct_orders_discounted_30d", ratio_or_zero("discounted_orders_30d", "orders_30d")
    )


def _discount_summary(grouped: DataFrame) -> DataFrame:
    """Rates on top of the 12-month sums."""
    return grouped.withColumns({
        "discounted_order_share": ratio("discounted_orders_12m", "orders_12m"),
        "discount_rate": ratio("discount_total_12m", "gross_12m"),
        "aov_gross": money_per("gross_12m", "orders_12m"),
        "aov_net": money_per("net_12m", "orders_12m"),
    })


def _discount_sums() -> list[Column]:
    return [
        F.sum("orders_count").alias("orders_12m"),
        F.sum("discounted_orders").alias("discounted_orders_12m"),
        total_money("pre_discount_sales").alias("gross_12m"),
        total_money("discount_amount_abs").alias("discount_total_12m"),
        total_money("net_sales_after_discounts").alias("net_12m"),
    ]


def discount_summary_overall_12m(g4: DataFrame) -> DataFrame:
    """One row for all stores (our definition); gross is before discounts."""
    return _discount_summary(g4.filter(last_12_months(g4)).agg(*_discount_sums()))


def discount_summary_store_12m(g4: DataFrame) -> DataFrame:
    """The same per store (our definition)."""
    recent = g4.filter(last_12_months(g4))
    return _discount_summary(recent.groupBy("restaurant_id").agg(*_discount_sums()))


def discount_orders_90d(
    items: DataFrame, options: DataFrame, newest: Column | None = None
) -> DataFrame:
    """Order-grain discount rows of the last 91 days (our definition).

    ``newest`` may come from a mart, which spares a pass over the lines.
    """
    end = latest(items) if newest is None else newest
    recent = items.filter(F.col("order_date").between(F.date_sub(end, 90), end))
    orders = orders_discount(enrich_lines(recent, options_of_lines(options, recent)))
    money = ["order_pre_total", "order_net_total", "order_discount_abs"]
    return orders.withColumns({c: F.col(c).cast(MART_MONEY) for c in money})
