"""Raw text -> clean tables with rejects; bronze -> silver; day extracts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dinerlake.functions import cleansing as cl
from dinerlake.functions.dates import month_name, shift_days, weekday_name
from dinerlake.functions.numeric import line_total
from dinerlake.operators import quality as ql
from dinerlake.operators.dedupe import dedupe_items, dedupe_options, first_per_key
from dinerlake.operators.joins import join_to_unique, keep_matching
from dinerlake.schemas import (
    LINE_KEY, MAX_CATEGORY, MAX_NAME, OPTION_KEY, UNIT_PRICE, columns_of,
)
from dinerlake.session import cut_lineage


# --- raw text ---------------------------------------------------------------

def typed_items(raw: DataFrame) -> DataFrame:
    """Raw item columns under their table names, parsed and masked."""
    return raw.select(
        F.col("APP_NAME").alias("app_name"),
        F.col("RESTAURANT_ID").alias("restaurant_id"),
        cl.parse_timestamp("CREATION_TIME_UTC").alias("creation_time_utc"),
        F.col("ORDER_ID").alias("order_id"),
        F.col("USER_ID").alias("user_id"),
        cl.mask_card("PRINTED_CARD_NUMBER").alias("printed_card_number"),
        cl.parse_bool("IS_LOYALTY").alias("is_loyalty"),
        F.col("CURRENCY").alias("currency"),
        F.col("LINEITEM_ID").alias("lineitem_id"),
        cl.strip_urls("ITEM_CATEGORY").alias("item_category"),
        F.col("ITEM_NAME").alias("item_name"),
        cl.parse_money("ITEM_PRICE").alias("item_price"),
        cl.parse_int("ITEM_QUANTITY").alias("item_quantity"),
    )


def one_per(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, chosen by all other columns so the choice is repeatable."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    return first_per_key(df, keys, rest)


def counted_per_key(df: DataFrame, keys: list[str], alone: Column) -> DataFrame:
    """One row per key, chosen by all other columns, with the number of its ``copies``.

    Rows for which ``alone`` holds are no copies of each other and all stay: each takes a number of
    its own into the key, which also spreads them over the tasks.  The choice is a minimum, NULLs
    last, so the copies of a key collapse in each task before the shuffle, and ``df`` is read once.
    """
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[
        field for i, c in enumerate(rest)
        for field in (F.col(c).isNull().alias(f"null_{i}"), F.col(c).alias(f"value_{i}"))])
    own = F.when(alone, F.monotonically_increasing_id())
    least = df.select(*keys, own.alias("_own"), ranked.alias("_row")).groupBy(*keys, "_own").agg(
        F.min("_row").alias("_row"), F.count(F.lit(1)).alias("copies"))
    chosen = {c: F.col(f"_row.value_{i}").alias(c) for i, c in enumerate(rest)}
    return least.select(*[chosen.get(c, F.col(c)) for c in df.columns], "copies")


def counted_items(raw: DataFrame) -> DataFrame:
    """Typed lines with ``copies`` and their reject reason or NULL; one per (order, line) where
    both are known."""
    keyless = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in LINE_KEY])
    return ql.with_reason(
        counted_per_key(typed_items(raw), LINE_KEY, keyless), ql.item_reject_reason())


def judged_items(raw: DataFrame) -> DataFrame:
    """Typed lines with their reject reason or NULL; one per (order, line) where both are known."""
    return counted_items(raw).drop("copies")


def clean_items(raw: DataFrame) -> DataFrame:
    return ql.accepted(judged_items(raw))


def typed_options(raw: DataFrame) -> DataFrame:
    """Raw option columns parsed; over-long names are cut, not rejected."""
    return raw.select(
        F.col("ORDER_ID").alias("order_id"),
        F.col("LINEITEM_ID").alias("lineitem_id"),
        cl.cap("OPTION_GROUP_NAME", MAX_CATEGORY).alias("option_group_name"),
        cl.cap("OPTION_NAME", MAX_NAME).alias("option_name"),
        cl.parse_money("OPTION_PRICE").alias("option_price"),
        cl.parse_int("OPTION_QUANTITY").alias("option_quantity"),
    )


def judged_options(raw: DataFrame) -> DataFrame:
    return ql.with_reason(typed_options(raw), ql.option_reject_reason())


def counted_options(raw: DataFrame) -> DataFrame:
    """Judged options with ``copies``; one per key of the good ones, all of the others."""
    return counted_per_key(judged_options(raw), OPTION_KEY, F.col("reason").isNotNull())


def clean_options(raw: DataFrame) -> DataFrame:
    return one_per(ql.accepted(judged_options(raw)), OPTION_KEY)


def rejected_options(raw: DataFrame) -> DataFrame:
    """Options without a key or a readable price, with the reason."""
    return ql.rejected(judged_options(raw))


def typed_dates(raw: DataFrame) -> DataFrame:
    """Parsed dates; ``date_key_str`` keeps the text as it came."""
    return (
        raw.withColumn("date_key_str", F.col("date_key"))
        .withColumn("date_key", cl.parse_date(F.trim("date_key")))
        .withColumn("is_weekend", cl.parse_bool("is_weekend"))
        .withColumn("is_holiday", cl.parse_bool("is_holiday"))
    )


def judged_dates(raw: DataFrame) -> DataFrame:
    return ql.with_reason(typed_dates(raw), ql.date_reject_reason())


def clean_dates(raw: DataFrame) -> DataFrame:
    """Readable dates with year, week, month name and weekday repaired."""
    return repaired_dates(ql.accepted(judged_dates(raw)))


def repaired_dates(good: DataFrame) -> DataFrame:
    def number_or(name: str, derived: Column) -> Column:
        return F.coalesce(F.when(F.col(name).rlike(r"^\d+$"), cl.parse_int(name)), derived)

    numbered = F.col("month").rlike(r"^\d+$")
    first_of_month = F.try_to_date(
        F.concat(F.lit("2000-"), F.col("month"), F.lit("-1")), "yyyy-M-d"
    )
    return good.select(
        "date_key",
        weekday_name("date_key").alias("day_of_week"),
        number_or("week", F.weekofyear("date_key")).alias("week"),
        F.when(numbered, month_name(first_of_month))
        .otherwise(F.coalesce("month", month_name("date_key"))).alias("month"),
        number_or("year", F.year("date_key")).alias("year"),
        "is_weekend",
        "is_holiday",
        "holiday_name",
    )


@dataclass(frozen=True)
class Seed:
    """Clean tables and rejects of one raw delivery."""

    items: DataFrame
    options: DataFrame
    dates: DataFrame
    rejected_items: DataFrame
    rejected_options: DataFrame
    orphan_options: DataFrame
    rejected_dates: DataFrame


def split_judged(items: DataFrame, options: DataFrame, dates: DataFrame) -> Seed:
    """Clean tables and rejects from the judged ones; pass written tables, they are read
    several times."""
    good = ql.accepted(items)
    typed = one_per(ql.accepted(options), OPTION_KEY)
    return Seed(
        items=good,
        options=ql.parented_options(typed, good),
        dates=repaired_dates(ql.accepted(dates)),
        rejected_items=ql.rejected(items),
        rejected_options=ql.rejected(options),
        orphan_options=ql.orphan_options(typed, good),
        rejected_dates=ql.rejected(dates),
    )


def seed(raw_items: DataFrame, raw_options: DataFrame, raw_dates: DataFrame) -> Seed:
    return split_judged(
        judged_items(raw_items), judged_options(raw_options), judged_dates(raw_dates))


def with_parent(options: DataFrame, items: DataFrame) -> DataFrame:
    """Judged options with ``has_parent``: true where a good line has their key, else NULL."""
    parents = ql.accepted(items).select(*LINE_KEY, F.lit(True).alias("has_parent"))
    return join_to_unique(options, parents, LINE_KEY)


def loss_audit(
    raw_items: DataFrame, raw_options: DataFrame, raw_dates: DataFrame
) -> DataFrame:
    """How many rows each cleansing step lost, as (metric, rows).

    Each raw table is scanned once.  The keys and reasons of the lines are written once, as both
    their own counts and the options' parents come from them.
    """
    items = cut_lineage(counted_items(raw_items).select(*LINE_KEY, "reason", "copies"))
    options = with_parent(counted_options(raw_options), items)
    return audit_of(items, options, judged_dates(raw_dates))


def audit_of(items: DataFrame, options: DataFrame, dates: DataFrame) -> DataFrame:
    """The loss audit from counted lines, counted options with ``has_parent`` and judged dates.

    Every table is counted in one pass into one row; the rows are stacked.
    """
    total, copies, reason = F.count(F.lit(1)), F.coalesce(F.sum("copies"), F.lit(0)), F.col("reason")
    good, bad = F.count_if(reason.isNull()), F.count_if(reason.isNotNull())
    counts = [
        items.agg(
            copies.alias("items_raw"),
            copies.alias("items_after_casts"),
            (copies - total).alias("items_dupes_removed"),
            good.alias("items_clean"),
            bad.alias("items_rejected"),
            *[F.count_if(reason == r).alias(f"items_rejected_{r}") for r, _ in ql.ITEM_RULES],
        ),
        options.agg(
            copies.alias("opts_raw"),
            bad.alias("opts_rejected"),
            *[F.count_if(reason == r).alias(f"opts_rejected_{r}") for r, _ in ql.OPTION_RULES],
            good.alias("opts_clean"),
            (copies - total).alias("opts_dupes_removed"),
            F.count_if(reason.isNull() & F.col("has_parent").isNotNull()).alias("opts_parented"),
            F.count_if(reason.isNull() & F.col("has_parent").isNull()).alias("opts_orphans"),
        ),
        dates.agg(
            total.alias("date_dim_raw"), bad.alias("date_dim_bad"), good.alias("date_dim_good")
        ),
    ]
    stacked = [c.unpivot([], c.columns, "metric", "rows") for c in counts]
    return reduce(DataFrame.unionByName, stacked)


# --- bronze -----------------------------------------------------------------

def items_of_days(items: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Lines created from ``start`` to ``end``, as a half-open time range."""
    created = F.col("creation_time_utc")
    after = end + dt.timedelta(days=1)
    return items.filter(
        (created >= F.lit(start).cast("timestamp")) & (created < F.lit(after).cast("timestamp"))
    )


def options_of_orders(options: DataFrame, items: DataFrame) -> DataFrame:
    """Options of the orders that occur in ``items``; the ids stay distributed."""
    return keep_matching(options, items, ["order_id"])


def bronze_items(items: DataFrame) -> DataFrame:
    """One row per (order, line) of the extract."""
    return one_per(items, LINE_KEY)


# --- silver -----------------------------------------------------------------

def silver_items(bronze: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    """Typed lines with order_date and order_total, one per line content."""
    typed = bronze.withColumns({
        "item_price": F.col("item_price").cast(UNIT_PRICE),
        "item_quantity": F.col("item_quantity").cast("int"),
        "is_loyalty": F.col("is_loyalty").cast("boolean"),
        "creation_time_utc": F.col("creation_time_utc").cast("timestamp"),
        "ingestion_date": F.to_date("ingestion_date"),
    })
    derived = typed.withColumns({
        "order_date": F.to_date("creation_time_utc"),
        "order_total": line_total("item_price", "item_quantity"),
    })
    return dedupe_items(derived.select(*columns_of("silver_order_items")), within)


def silver_options(bronze: DataFrame, within: Sequence[str] = ()) -> DataFrame:
    typed = bronze.withColumns({
        "option_price": F.col("option_price").cast(UNIT_PRICE),
        "option_quantity": F.col("option_quantity").cast("int"),
        "ingestion_date": F.to_date("ingestion_date"),
    })
    return dedupe_options(typed.select(*columns_of("silver_order_items_options")), within)


# --- replay -----------------------------------------------------------------

def replayed_items(
    items: DataFrame, source: dt.date, target: dt.date, limit: int, ingested: dt.date
) -> DataFrame:
    """Up to ``limit`` lines of the source day, moved to the target day.

    The sample is the first lines by key, so a second replay takes the same ones.
    A replayed order is an order of its own: its id gets the target day as a suffix, or
    its lines would count as new versions of the lines that they copy.
    """
    sampled = items_of_days(items, source, source).orderBy(
        *LINE_KEY, *[c for c in items.columns if c not in LINE_KEY]
    ).limit(limit)
    moved = shift_days("creation_time_utc", (target - source).days)
    return sampled.withColumns({
        "order_id": replayed_id(target),
        "creation_time_utc": moved,
        "ingestion_date": F.lit(ingested),
    })


def replayed_id(target: dt.date) -> Column:
    return F.concat("order_id", F.lit(f"@{target}"))


def replayed_options(
    options: DataFrame, items: DataFrame, target: dt.date, ingested: dt.date
) -> DataFrame:
    """Options of the replayed ``items``, under the ids of the replay."""
    renamed = options.withColumn("order_id", replayed_id(target))
    return options_of_orders(renamed, items).withColumn("ingestion_date", F.lit(ingested))
