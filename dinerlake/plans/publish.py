"""The business views of a lake under their published names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from dinerlake.plans import views
from dinerlake.sources.catalog import publish
from dinerlake.sources.lakehouse import Lakehouse

# Tables in the order of the function's arguments.
SALES, ITEMS, FACTS, DISCOUNTS, DATES, LINES, OPTIONS = (
    "gold_daily_sales_by_store", "gold_item_sales_by_day", "gold_customer_facts",
    "gold_discounts_by_day", "silver_date_dim", "silver_order_items", "silver_order_items_options",
)
VIEWS: dict[str, tuple[Callable[..., DataFrame], list[str]]] = {
    "v_sales_trends_daily": (views.sales_trends_daily, [SALES]),
    "v_top_items_30d": (views.top_items_30d, [ITEMS]),
    "v_loyalty_mix_daily": (views.loyalty_mix_daily, [SALES]),
    "v_discounts_by_day": (views.discounts_daily, [DISCOUNTS]),
    "v_sales_with_holidays_daily": (views.sales_with_holidays_daily, [SALES, DATES]),
    "v_store_sales_latest": (views.store_sales_latest, [SALES]),
    "v_customer_facts_latest": (views.customer_facts_latest, [FACTS]),
    "v_churn_risk_latest": (views.churn_risk_latest, [FACTS]),
    "v_customer_segments_latest": (views.customer_segments_latest, [FACTS]),
    "v_loyalty_vs_nonloyalty": (views.loyalty_vs_nonloyalty, [FACTS]),
    "v_sales_monthly_store": (views.sales_monthly_store, [SALES]),
    "v_sales_monthly_category": (views.sales_monthly_category, [ITEMS]),
    "v_sales_monthly_store_12m": (views.sales_monthly_store_12m, [SALES]),
    "v_category_mix_monthly_12m": (views.category_mix_monthly_12m, [ITEMS]),
    "v_sales_dow_store_12m": (views.sales_dow_store_12m, [SALES, DATES]),
    "v_holiday_uplift_12m": (views.holiday_uplift_12m, [SALES, DATES]),
    "v_location_performance_90d": (views.location_performance_90d, [SALES, LINES]),
    "v_location_actions_90d": (views.location_actions_90d, [SALES, LINES]),
    "v_item_sales_30d": (views.item_sales_30d, [ITEMS]),
    "v_discount_effectiveness_30d": (views.discount_effectiveness_30d, [DISCOUNTS]),
    "v_discount_summary_overall_12m": (views.discount_summary_overall_12m, [DISCOUNTS]),
    "v_discount_orders_90d": (views.discount_orders_90d, [LINES, OPTIONS]),
    "v_discount_summary_store_12m": (views.discount_summary_store_12m, [DISCOUNTS]),
}


def lake_views(lake: Lakehouse) -> dict[str, DataFrame]:
    return {name: build(*map(lake.read, tables)) for name, (build, tables) in VIEWS.items()}


def publish_views(lake: Lakehouse) -> list[str]:
    """Register every view of the lake for SQL; returns their names."""
    found = lake_views(lake)
    publish(found)
    return sorted(found)
