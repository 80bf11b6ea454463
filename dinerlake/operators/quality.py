"""Reject rules, key checks, loss audit, assertions and reconciliations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dinerlake.operators.joins import drop_matching, keep_matching
from dinerlake.schemas import LINE_KEY, MAX_CATEGORY, MAX_NAME, OPTION_KEY


class QualityError(RuntimeError):
    """A table does not meet a stated condition."""


# --- reject rules -----------------------------------------------------------

# The published labels and limits, in the order in which they are tried.
# Category and name may be NULL: an unknown length breaks no rule.
ITEM_RULES = [
    ("NULL_creation_time", "creation_time_utc is null"),
    ("NULL_key", "order_id is null or lineitem_id is null"),
    ("item_category_too_long", f"length(item_category) > {MAX_CATEGORY}"),
    ("item_name_too_long", f"length(item_name) > {MAX_NAME}"),
    ("bad_price", "item_price is null"),
]
OPTION_RULES = [
    ("NULL_key", " or ".join(f"{c} is null" for c in OPTION_KEY)),
    ("bad_price", "option_price is null"),
]


def first_broken(rules: Sequence[tuple[str, str]]) -> Column:
    """Label of the first rule that a row breaks, NULL for a good row."""
    return F.coalesce(*[F.when(F.expr(broken), label) for label, broken in rules])


def item_reject_reason() -> Column:
    return first_broken(ITEM_RULES)


def option_reject_reason() -> Column:
    return first_broken(OPTION_RULES)


def date_reject_reason() -> Column:
    return F.when(F.col("date_key").isNull(), "bad_date")


def with_reason(df: DataFrame, reason: Column) -> DataFrame:
    return df.withColumn("reason", reason)


def accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNull()).drop("reason")


def rejected(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("reason").isNotNull())


def rejects_by_reason(judged: DataFrame) -> DataFrame:
    return rejected(judged).groupBy("reason").count().withColumnRenamed("count", "rows")


# --- parent keys ------------------------------------------------------------

def parented_options(options: DataFrame, parents: DataFrame) -> DataFrame:
    return keep_matching(options, parents, LINE_KEY)


def orphan_options(options: DataFrame, parents: DataFrame) -> DataFrame:
    return drop_matching(options, parents, LINE_KEY).withColumn(
        "reason", F.lit("missing_parent")
    )


# --- assertions -------------------------------------------------------------

def assert_has_columns(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise QualityError(f"missing columns: {missing}")


def assert_nonempty(df: DataFrame, name: str = "table") -> None:
    if df.isEmpty():
        raise QualityError(f"{name} has no rows")


def assert_partition_present(df: DataFrame, column: str, value: object) -> None:
    if df.filter(F.col(column) == F.lit(value)).isEmpty():
        raise QualityError(f"no rows for {column}={value}")


def assert_no_nulls(df: DataFrame, columns: Sequence[str]) -> None:
    """All columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    bad = {c: counts[c] for c in columns if counts[c]}
    if bad:
        raise QualityError(f"unexpected NULLs: {bad}")


def assert_latest(df: DataFrame, column: str, expected: object) -> None:
    newest = df.agg(F.max(column)).first()[0]
    if str(newest) != str(expected):
        raise QualityError(f"newest {column} is {newest}, expected {expected}")


# --- reconciliations --------------------------------------------------------

def reconcile_items(g2: DataFrame) -> DataFrame:
    """Item sales plus option sales against the stored total."""
    gap = F.col("item_sales_only") + F.col("attached_options_sales") - F.col("sales_total")
    return g2.agg(F.max(F.abs(gap)).alias("max_diff"))


def reconcile_discounts(g4: DataFrame) -> DataFrame:
    """Sales before discounts less the discounts against the net; and order counts."""
    gap = (
        F.col("pre_discount_sales") - F.col("discount_amount_abs")
        - F.col("net_sales_after_discounts")
    )
    return g4.agg(
        F.max(F.abs(gap)).alias("max_diff"),
        F.min(F.col("orders_count") - F.col("discounted_orders")).alias("min_gap"),
    )


def cross_check_marts(g4: DataFrame, g1: DataFrame) -> DataFrame:
    """Net sales against gross sales of the same store and day.

    Gross already contains the negative options, so the two are equal.
    """
    keys = ["restaurant_id", "order_date"]
    return (
        g4.select(*keys, "net_sales_after_discounts")
        .join(g1.select(*keys, "gross_sales_total"), keys)
        .withColumn(
            "diff", F.abs(F.col("net_sales_after_discounts") - F.col("gross_sales_total"))
        )
    )


def freshness(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Row count, first and last date of each table; value is (table, date column)."""
    profiles = [
        df.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min(date_col).cast("date").alias("min_date"),
            F.max(date_col).cast("date").alias("max_date"),
        ).select(F.lit(name).alias("table_name"), "row_count", "min_date", "max_date")
        for name, (df, date_col) in tables.items()
    ]
    return reduce(DataFrame.unionByName, profiles)


def rows_per_date(df: DataFrame, date_col: str) -> DataFrame:
    return df.groupBy(date_col).agg(F.count(F.lit(1)).alias("row_count"))
