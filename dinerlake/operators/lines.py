"""Roll-up ladder: options -> line -> order.

Options are summed per line before they meet the lines, so the join never
multiplies rows and one busy line cannot fan out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dinerlake.functions.numeric import extended_price, zero
from dinerlake.operators.joins import join_to_unique, keep_matching
from dinerlake.schemas import LINE_KEY, ORDER_MONEY

SPLIT_COLUMNS = ["options_regular_total", "options_discounts_total"]


def options_per_line(options: DataFrame) -> DataFrame:
    """Net option amount of each line."""
    return options.groupBy(*LINE_KEY).agg(
        F.sum(extended_price()).cast(ORDER_MONEY).alias("options_total")
    )


def options_split_per_line(options: DataFrame) -> DataFrame:
    """Add-ons and discounts of each line apart, with the number of discounts.

    A discount is counted by its price, but its amount is split by the sign of
    price times quantity; the two differ when the quantity is not positive.
    """
    amount = F.col("extended")
    return options.withColumn("extended", extended_price()).groupBy(*LINE_KEY).agg(
        F.sum(F.when(amount >= 0, amount).otherwise(zero(ORDER_MONEY)))
        .cast(ORDER_MONEY).alias("options_regular_total"),
        F.sum(F.when(amount < 0, amount).otherwise(zero(ORDER_MONEY)))
        .cast(ORDER_MONEY).alias("options_discounts_total"),
        F.count_if(F.col("option_price") < 0).alias("discount_count_line"),
    )


def options_of_lines(options: DataFrame, lines: DataFrame) -> DataFrame:
    """Only the options whose line is present; used before summing them."""
    return keep_matching(options, lines, LINE_KEY)


def enrich_lines(
    lines: DataFrame, options: DataFrame, unique_lines: bool = False, clustered: bool = False
) -> DataFrame:
    """Each line with its option amounts and totals, shared by all marts.

    ``unique_lines`` says that (order_id, lineitem_id) is unique, as it is after
    the silver read; the join is then one to one.  ``clustered`` says that both sides come out of
    a shuffle by order_id: under ``session.keep_clusters`` the join and the roll-ups to orders then
    move no rows.  A hot line is then split only where the sides were dealt out, not here.
    """
    totals = options_split_per_line(options)
    if unique_lines or clustered:
        added = [c for c in totals.columns if c not in LINE_KEY]
        joined = lines.join(totals, LINE_KEY, "left").select(*lines.columns, *added)
    else:
        joined = join_to_unique(lines, totals, LINE_KEY)
    filled = joined.withColumns(
        {c: F.coalesce(F.col(c), zero(ORDER_MONEY)) for c in SPLIT_COLUMNS}
        | {"discount_count_line": F.coalesce(F.col("discount_count_line"), F.lit(0))}
    )
    regular, discounts = (F.col(c) for c in SPLIT_COLUMNS)
    pre = F.col("order_total") + regular
    return filled.withColumns({
        "options_total": (regular + discounts).cast(ORDER_MONEY),
        "line_total": (pre + discounts).cast(ORDER_MONEY),
        "line_pre_total": pre.cast(ORDER_MONEY),
        "has_discount_line": F.col("discount_count_line") > 0,
    })


def orders_by_store(enriched: DataFrame) -> DataFrame:
    """Store, date and order grain; one loyal line makes the order loyal."""
    return enriched.groupBy("restaurant_id", "order_date", "order_id").agg(
        F.sum("line_total").cast(ORDER_MONEY).alias("order_gross"),
        F.sum("order_total").cast(ORDER_MONEY).alias("order_item_sales"),
        F.sum("options_total").cast(ORDER_MONEY).alias("order_option_sales"),
        F.sum("item_quantity").alias("order_items_count"),
        F.coalesce(F.bool_or("is_loyalty"), F.lit(False)).alias("is_loyalty_order"),
    )


def orders_by_user(enriched: DataFrame) -> DataFrame:
    """User, date and order grain; lines without a user are left out."""
    known = enriched.filter(F.col("user_id").isNotNull())
    return known.groupBy("user_id", "order_date", "order_id").agg(
        F.sum("line_total").cast(ORDER_MONEY).alias("order_gross"),
        F.sum("item_quantity").alias("order_items_count"),
        F.coalesce(F.bool_or("is_loyalty"), F.lit(False)).alias("is_loyalty_order"),
    )


def orders_discount(enriched: DataFrame) -> DataFrame:
    """Store, date and order grain with amounts before and after discounts."""
    return enriched.groupBy("restaurant_id", "order_date", "order_id").agg(
        F.sum("line_pre_total").cast(ORDER_MONEY).alias("order_pre_total"),
        F.sum("line_total").cast(ORDER_MONEY).alias("order_net_total"),
        F.sum(-F.col("options_discounts_total")).cast(ORDER_MONEY).alias("order_discount_abs"),
        F.sum("discount_count_line").alias("order_discount_count"),
        F.bool_or("has_discount_line").alias("has_discount_order"),
    )
