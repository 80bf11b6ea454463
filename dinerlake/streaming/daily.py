"""Day runs over a lakehouse.

Every step replaces exactly the partitions of its days, also those that end up empty,
so a day can be run again at any time and days can be run in any order.  A line is
(order, line item); of several versions the newest counts, in the marts, in the
snapshot and in compaction alike.  A range of days is one set of Spark jobs, not a
loop over days.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dinerlake.operators import quality as ql
from dinerlake.operators.calendar import date_dim, upsert_dates
from dinerlake.operators.dedupe import current_items, current_options
from dinerlake.operators.joins import drop_older, keep_matching
from dinerlake.operators.lines import enrich_lines, options_of_lines, orders_by_user
from dinerlake.plans import marts
from dinerlake.plans import silver as sv
from dinerlake.schemas import LINE_KEY, OPTION_KEY, columns_of
from dinerlake.session import cut_lineage
from dinerlake.sources import files
from dinerlake.sources.lakehouse import Lakehouse
from dinerlake.streaming import locator

DAY_MARTS = {
    "gold_daily_sales_by_store": marts.daily_sales_by_store,
    "gold_item_sales_by_day": marts.item_sales_by_day,
    "gold_discounts_by_day": marts.discounts_by_day,
}

# Kept by order date as well: what the customer snapshot is made of.
STATE = "gold_user_orders"
DAY_TABLES = DAY_MARTS | {STATE: orders_by_user}


def yesterday() -> dt.date:
    return dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)


# --- bronze -----------------------------------------------------------------

def days_of(start: dt.date, end: dt.date) -> list[dt.date]:
    return [start + dt.timedelta(days=n) for n in range((end - start).days + 1)]


def extract(
    lake: Lakehouse, items: DataFrame, options: DataFrame, start: dt.date, end: dt.date
) -> bool:
    """Copy the lines created on these days, and their orders' options, to bronze.

    The partition is the creation day.  The source of the lines is read once;
    the order ids come from the copy.  Returns False when there was nothing to
    copy and nothing to remove, which is a success.
    """
    had = lake.days("bronze_order_items", str(start), str(end)) is not None
    created = F.to_date("creation_time_utc").cast("string")
    chosen = sv.items_of_days(items, start, end).withColumn("ingestion_date", created)
    days = days_of(start, end)
    lake.replace_partitions(
        "bronze_order_items", sv.one_per(chosen, ["ingestion_date", *LINE_KEY]), days
    )
    written = lake.range("bronze_order_items", str(start), str(end))
    if not had and written.isEmpty():
        return False
    ql.assert_has_columns(
        written, ["order_id", "lineitem_id", "item_price", "item_quantity", "ingestion_date"]
    )
    # An order may have lines on several of the days; its options go with each.
    order_days = written.select("order_id", "ingestion_date").distinct()
    wanted = options.select(
        *[c for c in columns_of("bronze_order_items_options") if c != "ingestion_date"]
    )
    lake.replace_partitions(
        "bronze_order_items_options", wanted.join(order_days, "order_id"), days
    )
    return True


# --- silver -----------------------------------------------------------------

def line_keys(lake: Lakehouse, start: dt.date, end: dt.date) -> DataFrame:
    """Keys and order dates of the silver lines in these ingestion days."""
    return lake.range("silver_order_items", start, end).select(*LINE_KEY, "order_date").distinct()


def refine(lake: Lakehouse, start: dt.date, end: dt.date) -> DataFrame:
    """Type and dedupe these ingestion days into silver, each day on its own.

    Returns the keys and order dates of the lines that were there before.
    """
    before = cut_lineage(line_keys(lake, start, end))
    days, day = days_of(start, end), ["ingestion_date"]
    items = lake.range("bronze_order_items", str(start), str(end))
    options = lake.range("bronze_order_items_options", str(start), str(end))
    lake.replace_partitions("silver_order_items", sv.silver_items(items, day), days)
    lake.replace_partitions("silver_order_items_options", sv.silver_options(options, day), days)
    return before


def compact(lake: Lakehouse) -> None:
    """Keep only the newest version of each line and option.

    Only the partitions that hold a superseded version are read whole and written; the others
    keep their files.  A partition that was rewritten and one that was not yet give the same
    newest versions, so a compaction that fails midway can simply be run again.
    """
    _compact(lake, "silver_order_items", LINE_KEY, current_items)
    _compact(lake, "silver_order_items_options", OPTION_KEY, current_options)


def _compact(
    lake: Lakehouse, table: str, keys: Sequence[str], newest: Callable[[DataFrame], DataFrame]
) -> None:
    several = cut_lineage(several_versions(lake.read(table), keys))
    # One value per day of the calendar.
    days = [r[0] for r in several.select(F.explode("days")).distinct().collect()]
    if not days:
        return
    if None in days:
        lake.swap(table, newest(lake.read(table)))
        return
    dirty = drop_older(
        locator.parts(lake, table, days), several, keys, "ingestion_date", "last")
    with written_once(lake, newest(dirty)) as kept:
        lake.replace_partitions(table, kept, days)


def several_versions(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with a superseded version: their ``last`` ingestion date and the ``days`` that hold one.

    The newest day is among them if it has the key more than once.
    """
    per_day = rows.groupBy(*keys, "ingestion_date").agg(F.count(F.lit(1)).alias("n"))
    per_key = per_day.groupBy(*keys).agg(
        F.max(F.struct("ingestion_date", "n")).alias("top"),
        # At most one per day of the calendar.
        F.collect_list(F.struct("ingestion_date")).alias("days"))
    single = F.col("top.n") == 1
    old = F.filter("days", lambda d: ~d.ingestion_date.eqNullSafe(F.col("top.ingestion_date")) | ~single)
    return per_key.select(
        *keys, F.col("top.ingestion_date").alias("last"), F.transform(old, lambda d: d.ingestion_date).alias("days")
    ).filter(F.size("days") > 0)


def refresh_dates(
    lake: Lakehouse, start: dt.date, end: dt.date, holidays: DataFrame | None = None,
    on: Sequence[str] = ("date_key",),
) -> None:
    """Replace these days in the date dimension and keep all others.

    Without ``holidays`` only days that are not there yet are added.
    """
    existing = lake.find("silver_date_dim")
    known = holidays
    if known is None:
        known, on = lake.spark.createDataFrame([], "date_key date, holiday_name string"), ["date_key"]
    new = date_dim(lake.spark, start, end, known, on)
    if existing is None:
        merged = new
    elif holidays is None:
        merged = upsert_dates(new, existing)
    else:
        merged = upsert_dates(existing, new)
    lake.swap("silver_date_dim", merged)


def rewrite_bronze_dates(lake: Lakehouse, days: DataFrame) -> None:
    """Write date rows so that ingestion_date is the day itself."""
    named = days.withColumn("ingestion_date", F.col("date_key").cast("string"))
    lake.replace_partitions("bronze_date_dim", named)


# --- gold -------------------------------------------------------------------

def _silver(lake: Lakehouse) -> tuple[DataFrame, DataFrame]:
    return lake.read("silver_order_items"), lake.read("silver_order_items_options")


def _enrich(items: DataFrame, options: DataFrame) -> DataFrame:
    """Newest version of each line, with its newest options."""
    return enrich_lines(current_items(items), current_options(options), unique_lines=True)


def build_day_marts(
    lake: Lakehouse, start: dt.date, end: dt.date, before: DataFrame | None = None
) -> bool:
    """Rebuild the day marts of every order date that these ingestion days touch.

    ``before`` holds the lines that a re-run replaced.  A line that came with another date
    before, or does so no more, touches both dates.  All versions of the lines of the touched
    dates are read, so that each line counts once, on the date of its newest version; the
    locator names the ingestion partitions that hold them, and no others are read.
    """
    changed = line_keys(lake, start, end)
    if before is not None:
        changed = changed.unionByName(before).distinct()
    changed = cut_lineage(changed)
    if changed.isEmpty():
        return False
    if lake.find(STATE) is None and lake.find("gold_daily_sales_by_store") is not None:
        # A lake from before the state was kept: once, from the whole of silver.
        lake.swap(STATE, orders_by_user(_enrich(*_silver(lake))))
    locator.refresh(lake)
    # One value per day of the calendar.
    dates = locator.order_dates(lake, changed).union(changed.select("order_date"))
    touched = sorted({r[0] for r in dates.distinct().collect()})
    keys, items, options = locator.lines_of_dates(lake, touched)
    current = current_items(keep_matching(items, keys, LINE_KEY)).filter(F.col("order_date").isin(touched))
    enriched = enrich_lines(
        current, current_options(options_of_lines(options, current)), unique_lines=True)
    with written_once(lake, enriched) as once:
        _write_day_marts(lake, once, touched)
    for table in DAY_MARTS:
        ql.assert_no_nulls(
            lake.range(table, touched[0], touched[-1]), ["order_date", "restaurant_id"])
    return True


@contextmanager
def written_once(lake: Lakehouse, df: DataFrame) -> Iterator[DataFrame]:
    """A plain copy of ``df`` beside the tables of the lake, read by everything inside the block.

    It goes when the block ends well and stays after a failure.
    """
    path = f"{lake.root.rstrip('/')}/work/{uuid.uuid4().hex}"
    files.write_plain(df, path)
    yield files.read_table(lake.spark, path, df.schema)
    files.remove(lake.spark, path)


def _write_day_marts(
    lake: Lakehouse, enriched: DataFrame, days: Sequence[dt.date] | None = None
) -> None:
    for table, build in DAY_TABLES.items():
        lake.replace_partitions(table, build(enriched), days)


def newest_order_date(lake: Lakehouse) -> dt.date | None:
    """From the partitions of the store-day mart, which has every date with lines."""
    days = lake.find("gold_daily_sales_by_store")
    return None if days is None else days.agg(F.max("order_date")).first()[0]


def build_snapshot(lake: Lakehouse, snapshot: dt.date | None = None) -> dt.date:
    """Write the customer facts of one snapshot date, by default the newest order date.

    They come from the orders per user that the day runs keep by order date; lines are read
    only in a lake whose marts were never built.
    """
    newest, orders = newest_order_date(lake), lake.find(STATE)
    if newest is None or orders is None:
        items, options = _silver(lake)
        newest = items.agg(F.max("order_date")).first()[0]
        orders = orders_by_user(_enrich(items, options))
    if newest is None:
        raise ql.QualityError("silver_order_items has no rows to take a snapshot of")
    chosen = snapshot or newest
    facts = marts.facts_of_orders(orders, chosen)
    lake.replace_partitions("gold_customer_facts", facts, [chosen])
    written = lake.days("gold_customer_facts", chosen)
    if written is None:
        raise ql.QualityError(f"no customer facts for {chosen}")
    ql.assert_no_nulls(written, ["snapshot_date", "user_id"])
    if snapshot is None:
        # Snapshots of later days stay when the newest orders are withdrawn.
        upto = lake.read("gold_customer_facts").filter(F.col("snapshot_date") <= F.lit(chosen))
        ql.assert_latest(upto, "snapshot_date", chosen)
    return chosen


# --- whole runs -------------------------------------------------------------

def run_days(
    lake: Lakehouse,
    items: DataFrame,
    options: DataFrame,
    start: dt.date,
    end: dt.date,
    snapshot: bool = True,
    holidays: DataFrame | None = None,
) -> bool:
    """Bronze, silver, calendar and gold for the days from ``start`` to ``end``."""
    if not extract(lake, items, options, start, end):
        return False
    before = refine(lake, start, end)
    refresh_dates(lake, start, end, holidays)
    build_day_marts(lake, start, end, before)
    if snapshot and not lake.read("silver_order_items").isEmpty():
        build_snapshot(lake)
    return True


def run_day(
    lake: Lakehouse,
    items: DataFrame,
    options: DataFrame,
    day: dt.date | None = None,
    snapshot: bool = True,
) -> bool:
    """One day, by default yesterday in UTC."""
    chosen = day or yesterday()
    return run_days(lake, items, options, chosen, chosen, snapshot)


def full_refresh(lake: Lakehouse) -> None:
    """Rebuild all marts from the whole of silver.

    The lines are enriched and written once; the marts and the snapshot each read only the
    columns they need of that copy.  Days without lines disappear from the marts.
    """
    with written_once(lake, _enrich(*_silver(lake))) as enriched:
        for table, build in DAY_TABLES.items():
            lake.swap(table, build(enriched))
    build_snapshot(lake)


def replay_day(
    lake: Lakehouse, source: dt.date, target: dt.date, limit: int, ingested: dt.date
) -> None:
    """Append a sample of the source day to bronze as if it came on the target day.

    The same replay run again adds only the rows that are not there yet: none after a run that
    ended well, the rest after one that failed between the lines and their options.
    """
    day = str(source)  # the partition is the creation day
    items = lake.range("bronze_order_items", day, day).drop("ingestion_date")
    options = lake.range("bronze_order_items_options", day, day).drop("ingestion_date").distinct()
    sampled = cut_lineage(sv.replayed_items(items, source, target, limit, ingested))
    _append_new(lake, "bronze_order_items", sampled, ingested)
    _append_new(
        lake, "bronze_order_items_options",
        sv.replayed_options(options, sampled, target, ingested), ingested)


def _append_new(lake: Lakehouse, table: str, rows: DataFrame, ingested: dt.date) -> None:
    """Append the rows that their ingestion partition does not hold; that partition alone is read."""
    text = rows.withColumn("ingestion_date", F.col("ingestion_date").cast("string"))
    named = text.select(*columns_of(table))
    missing = cut_lineage(named.subtract(lake.range(table, str(ingested), str(ingested))))
    if not missing.isEmpty():
        lake.append(table, missing)
