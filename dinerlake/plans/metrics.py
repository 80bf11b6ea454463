"""Dashboard figures as DataFrame functions.

``stores``, ``start`` and ``end`` are the selection a reader makes; leaving them
out takes everything.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dinerlake.functions.dates import weekday_number
from dinerlake.functions.numeric import (
    change, mean_money, per_cent, ratio, share_of, total_money,
)
from dinerlake.operators.dedupe import first_n_per_key, first_per_key
from dinerlake.operators.quantiles import exact_quantiles
from dinerlake.operators.shaping import matrix, only_stores, selection, top
from dinerlake.plans.views import customer_facts_latest

TOP_CUSTOMERS = 200
TOP_SPENDERS = 500
AT_RISK = 200
TREND_PER_CENT = 5
DRIFT_SHARE = 0.01


# --- operational figures ----------------------------------------------------

def date_bounds(trends: DataFrame) -> DataFrame:
    return trends.agg(F.min("order_date").alias("min_d"), F.max("order_date").alias("max_d"))


def store_list(trends: DataFrame) -> DataFrame:
    return trends.select("restaurant_id").distinct().orderBy("restaurant_id")


def store_day_matrix(
    view: DataFrame,
    value: str,
    stores: Sequence[str] | None = None,
    start: object = None,
    end: object = None,
) -> DataFrame:
    """Dates down, one column per chosen store, by default per store of the view."""
    chosen = selection(view, stores, start, end)
    return matrix(chosen, "order_date", "restaurant_id", value, stores, prefix="store_")


def latest_day_kpi(
    trends: DataFrame,
    stores: Sequence[str] | None = None,
    start: object = None,
    end: object = None,
) -> DataFrame:
    """Each store's own last day within the selection."""
    chosen = selection(trends, stores, start, end)
    last = first_per_key(chosen, ["restaurant_id"], [F.desc("order_date")])
    return last.select(
        "restaurant_id", "order_date",
        F.col("gross_sales_total").alias("gross"),
        F.col("orders_count").alias("orders"),
        ratio("gross_sales_total", "orders_count").alias("aov"),
        F.col("loyalty_sales_pct").alias("loyalty_pct"),
    )


def top_items_by_store(
    item_sales: DataFrame, n: int = 10, stores: Sequence[str] | None = None
) -> DataFrame:
    """The ``n`` best-selling items of each store, with their rank."""
    rank = Window.partitionBy("restaurant_id").orderBy(
        F.desc("sales_30d"), F.asc_nulls_last("item_category"), F.asc_nulls_last("item_name")
    )
    ranked = only_stores(item_sales, stores).withColumn("rn_store", F.row_number().over(rank))
    return ranked.filter(F.col("rn_store") <= n).orderBy("restaurant_id", "rn_store")


def latest_discount_kpi(
    discounts: DataFrame,
    stores: Sequence[str] | None = None,
    start: object = None,
    end: object = None,
) -> DataFrame:
    """Discount sums per store on the last day of the selection."""
    chosen = selection(discounts, stores, start, end)
    last_day = chosen.agg(F.max("order_date")).scalar()
    return chosen.filter(F.col("order_date") == last_day).groupBy("restaurant_id").agg(
        total_money("pre_discount_sales").alias("pre"),
        total_money("discount_amount_abs").alias("disc"),
        total_money("net_sales_after_discounts").alias("net"),
        F.avg("pct_sales_discounted").alias("pct"),
    )


def top_customers(g3: DataFrame, n: int = TOP_CUSTOMERS) -> DataFrame:
    latest = customer_facts_latest(g3).select(
        "user_id", "lifetime_orders", "lifetime_gross_sales", "avg_order_value",
        F.col("last_90d_orders_count").alias("last_90d_orders"), "last_90d_sales",
        "recency_score", "frequency_score", "monetary_score", "segment_label",
    )
    return top(latest, n, F.desc("last_90d_sales"), F.asc("user_id"))


# --- segments ---------------------------------------------------------------

def segment_loyalty_counts(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment_label", "is_loyalty_member").agg(
        F.count(F.lit(1)).alias("customers")
    )


def segment_loyalty_matrix(segments: DataFrame) -> DataFrame:
    member = F.col("is_loyalty_member")
    return segments.groupBy("segment_label").agg(
        F.sum(F.when(~member, 1)).alias("non_members"),
        F.sum(F.when(member, 1)).alias("members"),
    )


def top_spenders(segments: DataFrame, n: int = TOP_SPENDERS) -> DataFrame:
    best = top(segments, n, F.desc("last_90d_sales"), F.asc("user_id"))
    return best.select(
        "user_id", "segment_label", "last_90d_sales",
        "recency_score", "frequency_score", "monetary_score",
    )


def segment_summary(g3: DataFrame) -> DataFrame:
    """Size, share, loyalty, value and recent sales of each segment."""
    counted = customer_facts_latest(g3).groupBy("segment_label").agg(
        F.count(F.lit(1)).alias("customers"),
        share_of(F.col("loyalty_orders") > 0).alias("loyalty_share"),
        mean_money("lifetime_gross_sales").alias("avg_clv"),
        total_money(F.coalesce("last_90d_sales", F.lit(0))).alias("sales_90d"),
    )
    # The grand totals run over the four segment rows only.
    all_segments = Window.partitionBy()
    return counted.select(
        "segment_label", "customers",
        ratio("customers", F.sum("customers").over(all_segments)).alias("customer_share"),
        "loyalty_share", "avg_clv", "sales_90d",
        ratio("sales_90d", F.sum("sales_90d").over(all_segments)).alias("sales_share"),
    )


def top_contributor(g3: DataFrame) -> DataFrame:
    """The segment with the largest share of recent sales."""
    best = top(
        segment_summary(g3), 1, F.desc_nulls_last("sales_share"), F.asc("segment_label")
    )
    return best.select("segment_label", "sales_90d", "sales_share")


# --- churn ------------------------------------------------------------------

def risk_counts(churn: DataFrame) -> DataFrame:
    return churn.groupBy("risk_level").agg(F.count(F.lit(1)).alias("customers"))


def at_risk_customers(churn: DataFrame, n: int = AT_RISK) -> DataFrame:
    """High-risk users, longest absence first, then the steepest drop."""
    high = churn.filter(F.col("risk_level") == "High").select(
        "user_id", "risk_level", "days_since_last_order", "avg_interorder_gap_days",
        "last_90d_orders", "last_90d_sales", "delta_90d_pct",
    )
    return top(
        high, n, F.desc("days_since_last_order"), F.asc_nulls_last("delta_90d_pct"),
        F.asc("user_id"),
    )


def churn_medians(churn: DataFrame) -> DataFrame:
    """Customers and exact medians per risk level, at any number of customers."""
    columns = {
        "days_since_last_order": "p50_days_since_last",
        "avg_interorder_gap_days": "p50_gap_days",
        "last_90d_orders": "p50_orders_90d",
        "last_90d_sales": "p50_sales_90d",
        "delta_90d_pct": "p50_delta_90d",
    }
    medians = exact_quantiles(churn, {c: [0.5] for c in columns}, by="risk_level")
    sizes = churn.groupBy("risk_level").agg(F.count(F.lit(1)).alias("customers"))
    return sizes.join(medians, "risk_level").select(
        "risk_level", "customers", *[F.col(c)[0].alias(name) for c, name in columns.items()]
    )


def churn_activity(churn: DataFrame) -> DataFrame:
    return churn.groupBy("risk_level").agg(
        share_of(F.col("last_90d_orders") > 0).alias("active_share_90d"),
        F.avg(F.coalesce("last_90d_orders", F.lit(0))).alias("mean_orders_90d"),
        mean_money(F.coalesce("last_90d_sales", F.lit(0))).alias("mean_sales_90d"),
    )


def churn_high_vs_low(churn: DataFrame) -> DataFrame:
    """One row: medians and activity of high and low risk side by side."""
    level = F.col("risk_level")
    both = churn_medians(churn).join(churn_activity(churn), "risk_level")
    figures = [
        "p50_days_since_last", "p50_gap_days", "active_share_90d",
        "mean_orders_90d", "mean_sales_90d",
    ]
    paired = [
        F.max(F.when(level == name, F.col(c))).alias(f"{name.lower()}_{c}")
        for c in figures for name in ("High", "Low")
    ]
    sizes = [
        F.coalesce(F.max(F.when(level == name, F.col("customers"))), F.lit(0))
        .alias(f"n_{name.lower()}")
        for name in ("High", "Medium", "Low")
    ]
    return both.agg(*paired, *sizes)


# --- trends and seasons -----------------------------------------------------

def last_months_change(
    monthly: DataFrame, n: int = 3, stores: Sequence[str] | None = None
) -> DataFrame:
    """Change of the last ``n`` months per store, in per cent."""
    last = first_n_per_key(
        only_stores(monthly, stores), ["restaurant_id"], [F.desc("month")], n
    )
    return last.select("restaurant_id", "month", per_cent("mom_pct", 1).alias("mom_pct"))


def store_trend_12m(monthly: DataFrame, stores: Sequence[str] | None = None) -> DataFrame:
    """First against last month, mean of the last three changes, and a word for it."""
    chosen = only_stores(monthly, stores)
    back = Window.partitionBy("restaurant_id").orderBy(F.desc("month"))
    ranked = chosen.withColumn("_back", F.row_number().over(back))
    sums = ranked.groupBy("restaurant_id").agg(
        F.min_by("gross_month", "month").alias("first_month"),
        F.max_by("gross_month", "month").alias("last_month"),
        F.avg(F.when(F.col("_back") <= 3, F.col("mom_pct"))).alias("avg_mom_last3"),
    )
    changed = sums.withColumn("pct_change_12m", change("last_month", "first_month"))
    pct = F.col("pct_change_12m") * 100
    return changed.withColumn(
        "direction",
        F.when(pct.isNull(), "mixed")
        .when(pct > TREND_PER_CENT, "rising")
        .when(pct < -TREND_PER_CENT, "declining")
        .otherwise("flat"),
    )


def best_mover(monthly: DataFrame, stores: Sequence[str] | None = None) -> DataFrame:
    return top(
        store_trend_12m(monthly, stores), 1,
        F.desc_nulls_last("pct_change_12m"), F.asc("restaurant_id"),
    )


def weekday_matrix(dow: DataFrame, stores: Sequence[str] | None = None) -> DataFrame:
    """Weekdays down from Monday, one column per store."""
    wide = matrix(
        only_stores(dow, stores), "day_of_week", "restaurant_id", "avg_sales_dow", stores,
        prefix="store_",
    )
    return wide.withColumn("day_no", weekday_number("day_of_week")).orderBy("day_no")


def weekday_profile(dow: DataFrame, stores: Sequence[str] | None = None) -> DataFrame:
    """Mean over stores per weekday, ranked; at most seven rows are ranked."""
    means = only_stores(dow, stores).groupBy("day_of_week").agg(
        F.avg(F.col("avg_sales_dow").cast("double")).alias("mean_sales")
    )
    # The rank runs over the seven weekday rows only.
    by_sales = Window.orderBy(F.desc("mean_sales"), weekday_number("day_of_week"))
    rank, days = F.col("sales_rank"), F.count(F.lit(1)).over(Window.partitionBy())
    ranked = means.withColumn("sales_rank", F.row_number().over(by_sales))
    return ranked.withColumn("_days", days).select(
        "day_of_week", "mean_sales", "sales_rank",
        F.when(rank == 1, "highest").when(rank == F.col("_days"), "lowest")
        .when(rank == 2, "second").alias("position"),
    )


def category_mix(mix: DataFrame, stores: Sequence[str] | None = None) -> DataFrame:
    """Mean share over stores by month and category."""
    return only_stores(mix, stores).groupBy("month", "item_category").agg(
        F.avg("sales_share").alias("sales_share")
    )


def category_mix_matrix(
    mix: DataFrame,
    categories: Sequence[str] | None = None,
    stores: Sequence[str] | None = None,
) -> DataFrame:
    return matrix(
        category_mix(mix, stores), "month", "item_category", "sales_share", categories,
        fill=0.0, prefix="share_",
    )


def category_drift(mix: DataFrame, stores: Sequence[str] | None = None) -> DataFrame:
    """Mean share per category, and its last three months against its first three.

    Months are counted as distinct months of the category, not as rows.
    """
    chosen = only_stores(mix, stores)
    share = F.col("sales_share")
    # Sums and counts per category-month: a small table whatever the store count.
    months = chosen.groupBy("item_category", "month").agg(
        F.sum(share).alias("total"), F.count(share).alias("n")
    )
    by_category = Window.partitionBy("item_category")
    ranked = months.withColumns({
        "_from_start": F.row_number().over(by_category.orderBy("month")),
        "_from_end": F.row_number().over(by_category.orderBy(F.desc("month"))),
    })

    def mean_where(condition: Column) -> Column:
        return ratio(
            F.sum(F.when(condition, F.col("total"))), F.sum(F.when(condition, F.col("n")))
        )

    drift = ranked.groupBy("item_category").agg(
        mean_where(F.lit(True)).alias("avg_share"),
        mean_where(F.col("_from_start") <= 3).alias("first3_share"),
        mean_where(F.col("_from_end") <= 3).alias("last3_share"),
    )
    moved = F.col("last3_share") - F.col("first3_share")
    return drift.withColumn("share_change", moved).withColumn(
        "direction",
        F.when(F.col("share_change") > DRIFT_SHARE, "rising")
        .when(F.col("share_change") < -DRIFT_SHARE, "falling")
        .otherwise("flat"),
    )


def top_holiday_uplift(uplift: DataFrame, stores: Sequence[str] | None = None) -> DataFrame:
    best = top(
        only_stores(uplift, stores), 1, F.desc_nulls_last("uplift_pct"),
        F.asc("restaurant_id"), F.asc("holiday_name"),
    )
    return best.withColumn("uplift_rounded", per_cent("uplift_pct", 0))


# --- loyalty ----------------------------------------------------------------

def loyalty_impact_summary(g3: DataFrame) -> DataFrame:
    """Members and others: customers, value, repeat rate and recent sales."""
    recent = F.coalesce(F.col("last_90d_sales"), F.lit(0))
    return (
        customer_facts_latest(g3)
        .groupBy((F.col("loyalty_orders") > 0).alias("is_loyalty_member"))
        .agg(
            F.count(F.lit(1)).alias("customers"),
            mean_money("lifetime_gross_sales").alias("avg_clv"),
            mean_money("avg_order_value").alias("avg_aov"),
            share_of(F.col("lifetime_orders") >= 2).alias("repeat_rate"),
            mean_money(recent).alias("mean_sales_90d"),
            total_money(recent).alias("total_sales_90d"),
        )
    )


def loyalty_effect_sizes(g3: DataFrame) -> DataFrame:
    """One row: how members differ from others; empty unless both exist."""
    member = F.col("is_loyalty_member")

    def of(flag: bool, column: str) -> Column:
        return F.max(F.when(member == flag, F.col(column)))

    def uplift(column: str) -> Column:
        return (ratio(of(True, column), of(False, column)) - 1) * 100

    sizes = loyalty_impact_summary(g3).agg(
        uplift("avg_clv").alias("clv_uplift_pct"),
        uplift("avg_aov").alias("aov_uplift_pct"),
        ((of(True, "repeat_rate") - of(False, "repeat_rate")) * 100).alias("repeat_diff_pp"),
        (ratio(of(True, "customers"), F.sum("customers")) * 100).alias("customer_share_pct"),
        (ratio(of(True, "total_sales_90d"), F.sum("total_sales_90d")) * 100)
        .alias("sales_share_pct"),
        F.count(F.lit(1)).alias("_groups"),
    )
    return sizes.filter("_groups = 2").drop("_groups")


# --- locations and discounts ------------------------------------------------

def store_ranking_90d(
    actions: DataFrame, stores: Sequence[str] | None = None
) -> DataFrame:
    return only_stores(actions, stores).orderBy(F.desc("gross_90d"), "restaurant_id")


def discount_totals(overall: DataFrame) -> DataFrame:
    """The figures shown for all stores together."""
    return overall.select(
        "orders_12m", "discounted_order_share", "discount_rate", "aov_gross", "aov_net",
        "gross_12m", "discount_total_12m", "net_12m",
    )


def store_net_ranking(
    by_store: DataFrame, stores: Sequence[str] | None = None
) -> DataFrame:
    return only_stores(by_store, stores).select(
        "restaurant_id", "orders_12m", "discounted_orders_12m", "gross_12m",
        "discount_total_12m", "net_12m", "discount_rate", "discounted_order_share",
        "aov_gross", "aov_net",
    ).orderBy(F.desc("net_12m"), "restaurant_id")


def top_stores_gross_net(
    by_store: DataFrame, n: int = 10, stores: Sequence[str] | None = None
) -> DataFrame:
    best = top(
        only_stores(by_store, stores), n, F.desc("net_12m"), F.asc("restaurant_id")
    )
    return best.select("restaurant_id", "gross_12m", "net_12m")
