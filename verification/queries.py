"""Registered queries: name -> function of (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dinerlake.functions import cleansing as cl
from dinerlake.operators import dedupe, lines, quality
from dinerlake.operators.calendar import upsert_dates
from dinerlake.plans import delivery, marts, metrics, reports, silver, views
from dinerlake.schemas import RAW_ITEMS
from dinerlake.sources import catalog, files
from dinerlake.sources import jdbc
from dinerlake.sources import sample_tables as st
from dinerlake.sources.lakehouse import Lakehouse
from dinerlake.streaming import daily
from verification.oracles import STORES
from verification.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Callable[[Workspace], DataFrame]] = {}
DIGITS = 6


def query(fn: Callable[[Workspace], DataFrame]) -> Callable[[Workspace], DataFrame]:
    REGISTRY[fn.__name__] = fn
    return fn


# --- ladder -----------------------------------------------------------------

@query
def options_per_line(w):
    return lines.options_per_line(w.options())


@query
def options_split_per_line(w):
    return lines.options_split_per_line(w.options())


@query
def enriched_lines(w):
    return w.enriched().select(
        "restaurant_id", "order_date", "order_id", "lineitem_id", "user_id", "is_loyalty",
        "item_quantity", "order_total", "options_regular_total", "options_discounts_total",
        "discount_count_line", "options_total", "line_total",
    )


@query
def orders_by_store(w):
    return lines.orders_by_store(w.enriched())


@query
def orders_by_user(w):
    return lines.orders_by_user(w.enriched())


@query
def orders_discount(w):
    return lines.orders_discount(w.enriched())


# --- marts ------------------------------------------------------------------

@query
def g1_daily_sales_by_store(w):
    return marts.daily_sales_by_store(w.enriched())


@query
def g2_item_sales_by_day(w):
    return marts.item_sales_by_day(w.enriched())


@query
def g3_customer_features(w):
    return marts.customer_features(w.enriched(), w.snapshot())


@query
def g3_rfm_scores(w):
    return marts.rfm_scores(marts.customer_features(w.enriched(), w.snapshot()))


@query
def g3_customer_facts(w):
    return marts.customer_facts(w.enriched(), w.snapshot())


@query
def g4_discounts_by_day(w):
    return marts.discounts_by_day(w.enriched())


@query
def date_dim(w):
    return w.dates()


# --- bronze and silver ------------------------------------------------------

@query
def silver_order_items(w):
    return silver.silver_items(w.items())


@query
def silver_dedupe_items(w):
    return dedupe.dedupe_items(w.items())


@query
def silver_dedupe_options(w):
    return dedupe.dedupe_options(w.options())


@query
def silver_current_items(w):
    return dedupe.current_items(w.items())


@query
def silver_current_options(w):
    return dedupe.current_options(w.options())


def _source_items(w):
    return w.items().select(*jdbc.ITEM_COLUMNS)


def _source_options(w):
    return w.options().select(*jdbc.OPTION_COLUMNS)


@query
def bronze_incremental_day(w):
    day = w.snapshot()
    return silver.bronze_items(silver.items_of_days(_source_items(w), day, day))


@query
def bronze_child_extract(w):
    day = w.snapshot()
    return silver.options_of_orders(
        _source_options(w), silver.items_of_days(_source_items(w), day, day)
    )


@query
def seed_clean_items(w):
    return silver.clean_items(w.arriving_items())


@query
def seed_rejected_items(w):
    return quality.rejected(silver.judged_items(w.arriving_items()))


@query
def seed_rejected_options(w):
    return silver.rejected_options(w.arriving_options())


@query
def seed_rejected_dates(w):
    return quality.rejected(silver.judged_dates(w.arriving_dates())).select(
        "date_key_str", "year", "month", "week", "reason")


@query
def csv_round_trip(w):
    """The raw lines written as CSV with their columns in another order, and read by name."""
    path, raw = f"{w.root}/csv_items", w.arriving_items()
    raw.select(*sorted(raw.columns, reverse=True)).write.mode("overwrite").options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return files.read_csv(w.spark, path, RAW_ITEMS)


@query
def seed_clean_dates(w):
    return silver.clean_dates(w.arriving_dates())


@query
def options_parented(w):
    return quality.parented_options(
        silver.clean_options(w.arriving_options()), silver.clean_items(w.arriving_items())
    )


@query
def options_orphans(w):
    return quality.orphan_options(
        silver.clean_options(w.arriving_options()), silver.clean_items(w.arriving_items())
    )


@query
def replay_day(w):
    source = w.snapshot()
    target = source + daily.dt.timedelta(days=1)
    return silver.replayed_items(_source_items(w), source, target, 2000, target)


# --- quality ----------------------------------------------------------------

@query
def reject_reasons(w):
    return quality.rejects_by_reason(silver.judged_items(w.arriving_items()))


@query
def loss_audit(w):
    return silver.loss_audit(w.arriving_items(), w.arriving_options(), w.arriving_dates())


def _delivery(w, name):
    return delivery.deliver(
        w.spark, f"{w.root}/{name}", w.arriving_items(), w.arriving_options(), w.arriving_dates())


@query
def delivery_options(w):
    """Clean options of a delivery that is read once and kept by verdict."""
    return _delivery(w, "delivery").seed().options


@query
def delivery_rejects(w):
    """Rejected lines and options and options without a parent, from the same copies."""
    kept = _delivery(w, "delivery_rejects").seed()
    parts = {"items": kept.rejected_items, "options": kept.rejected_options, "orphans": kept.orphan_options}
    rejects = [
        df.select(F.lit(name).alias("source"), "order_id", "lineitem_id", "reason")
        for name, df in parts.items()]
    return rejects[0].unionByName(rejects[1]).unionByName(rejects[2])


@query
def delivery_audit(w):
    return _delivery(w, "delivery_audit").audit()


@query
def reconcile_g2(w):
    return quality.reconcile_items(w.g2())


@query
def reconcile_g4(w):
    return quality.reconcile_discounts(w.g4())


@query
def cross_check_g4_g1(w):
    return quality.cross_check_marts(w.g4(), w.g1())


@query
def freshness_profile(w):
    w.enriched_copy()
    return quality.freshness({
        "silver_order_items": (w.passing_items(), "order_date"),
        "silver_date_dim": (w.dates(), "date_key"),
        "gold_daily_sales_by_store": (w.g1(), "order_date"),
        "gold_item_sales_by_day": (w.g2(), "order_date"),
        "gold_customer_facts": (w.g3(), "snapshot_date"),
        "gold_discounts_by_day": (w.g4(), "order_date"),
    })


@query
def rows_per_date(w):
    return quality.rows_per_date(w.g1(), "order_date")


# --- cleansing --------------------------------------------------------------

def _raw_key():
    return F.col("ORDER_ID").alias("order_id"), F.col("LINEITEM_ID").alias("lineitem_id")


@query
def clean_decimal(w):
    return w.arriving_items().select(
        *_raw_key(), F.col("ITEM_PRICE").alias("text"),
        cl.parse_money("ITEM_PRICE").alias("amount"),
    )


@query
def clean_bool(w):
    return w.arriving_items().select(
        *_raw_key(), F.col("IS_LOYALTY").alias("text"), cl.parse_bool("IS_LOYALTY").alias("flag")
    )


@query
def clean_dates(w):
    return w.arriving_dates().select(
        F.col("date_key").alias("text"), cl.parse_date(F.trim("date_key")).alias("day")
    )


@query
def mask_cards(w):
    return w.arriving_items().select(
        *_raw_key(), cl.mask_card("PRINTED_CARD_NUMBER").alias("card")
    )


@query
def strip_urls(w):
    return w.arriving_items().select(
        *_raw_key(), cl.strip_urls("ITEM_CATEGORY").alias("item_category")
    )


@query
def cap_names(w):
    capped = cl.cap("OPTION_NAME", 128)
    return w.arriving_options().select(
        *_raw_key(), capped.alias("option_name"), F.length(capped).alias("name_length")
    )


# --- sinks ------------------------------------------------------------------

@query
def write_read_dynamic_overwrite(w):
    """Write the mart by year, then replace the newest year alone by changed rows."""
    path = f"{w.root}/dynamic_overwrite"
    yearly = w.g1().withColumn("order_year", F.year("order_date"))
    files.overwrite_partitions(yearly, path, "order_year")
    changed = yearly.filter(F.col("order_year") == w.snapshot().year).withColumn(
        "orders_count", F.col("orders_count") + 1)
    files.overwrite_partitions(changed, path, "order_year")
    return files.read_table(w.spark, path).drop("order_year")


@query
def schemas_reconciled(w):
    """The store-day mart by year, each year written by another run: whole numbers as text and a new
    column, sums in cents and no loyalty columns, and as declared."""
    root = f"{w.root}/schemas/{daily.uuid.uuid4().hex[:8]}"
    yearly = w.g1().withColumn("order_year", F.year("order_date"))
    turn = F.col("order_year") % 3
    text = yearly.filter(turn == 0).withColumns({
        "orders_count": F.col("orders_count").cast("string"), "note": F.lit("x")})
    narrow = yearly.filter(turn == 1).drop("loyalty_sales", "loyalty_orders").withColumns({
        "items_count": F.col("items_count").cast("int"), "item_sales": F.col("item_sales").cast("decimal(14,4)")})
    for part in (text, narrow, yearly.filter(turn == 2)):
        files.overwrite_partitions(part, root, "order_year")
    declared = yearly.schema
    return files.read_reconciled(w.spark, root, declared, "order_year")


@query
def upsert_date_dim(w):
    """Give the newest day a holiday; all other days stay."""
    day = w.snapshot()
    new = st.dates(w.spark, day, day).withColumns({
        "holiday_name": F.lit("Inventory Day"), "is_holiday": F.lit(True),
    })
    return upsert_dates(w.dates(), new)


@query
def run_day_twice(w):
    """Bronze to gold for the newest day, run two times over."""
    lake = Lakehouse(w.spark, f"{w.root}/day_lake")
    for _ in range(2):
        daily.run_day(lake, _source_items(w), _source_options(w), w.snapshot(), snapshot=False)
    return lake.read("gold_daily_sales_by_store")


def _rerun(w, name, again_items=None, again_options=None):
    """The newest day run with everything, then again with a changed source."""
    lake = Lakehouse(w.spark, f"{w.root}/{name}")
    lines_, options_ = _source_items(w), _source_options(w)
    daily.run_day(lake, lines_, options_, w.snapshot(), snapshot=False)
    daily.run_day(
        lake, lines_ if again_items is None else again_items,
        options_ if again_options is None else again_options, w.snapshot(), snapshot=False)
    return lake.read("gold_daily_sales_by_store")


@query
def rerun_removed_rows(w):
    even = F.col("order_id").cast("bigint") % 2 == 0
    return _rerun(w, "rerun_rows", again_items=_source_items(w).filter(even))


@query
def rerun_removed_options(w):
    kept = _source_options(w).filter("option_name <> 'promo'")
    return _rerun(w, "rerun_options", again_options=kept)


def _with_moved_lines(w, name):
    """Two days; on the second a third of the first day's orders come again with its date."""
    lake, last = Lakehouse(w.spark, f"{w.root}/{name}"), w.snapshot()
    first = last - daily.dt.timedelta(days=1)
    lines_, options_ = _source_items(w), _source_options(w)
    daily.run_day(lake, lines_, options_, first, snapshot=False)
    moved = silver.items_of_days(lines_, first, first).filter(
        F.col("order_id").cast("bigint") % 3 == 0
    ).withColumn("creation_time_utc", F.col("creation_time_utc") + F.expr("interval 1 day"))
    both = silver.items_of_days(lines_, last, last).unionByName(moved)
    daily.run_day(lake, both, options_, last, snapshot=False)
    return lake


@query
def moved_line_counts_once(w):
    return _with_moved_lines(w, "moved").read("gold_daily_sales_by_store")


@query
def user_orders_state(w):
    """Orders per user as the day runs keep them, after lines have moved to another date."""
    return _with_moved_lines(w, "state").read("gold_user_orders")


@query
def line_locator(w):
    """Which ingestion partitions hold which line, after a day whose lines came again on the next."""
    return _with_moved_lines(w, "located").read("silver_item_locator")


@query
def compact_keeps_marts(w):
    lake = _with_moved_lines(w, "compacted")
    daily.compact(lake)
    daily.full_refresh(lake)
    return lake.read("gold_daily_sales_by_store")


@query
def compact_rewrites_superseded(w):
    """Lines of a compacted lake of three days and whether their partition was written anew."""
    lake, table = _with_moved_lines(w, "partly_compacted"), "silver_order_items"
    early = w.snapshot() - daily.dt.timedelta(days=2)
    daily.run_day(lake, _source_items(w), _source_options(w), early, snapshot=False)
    before = files.partition_times(w.spark, lake.path(table), "ingestion_date")
    daily.compact(lake)
    after = files.partition_times(w.spark, lake.path(table), "ingestion_date")
    rewritten = F.col("ingestion_date").cast("string").isin([d for d in after if after[d] != before[d]])
    return lake.read(table).select(
        "order_id", "lineitem_id", "order_date", "ingestion_date", rewritten.alias("rewritten"))


@query
def replay_run_twice(w):
    """Lines and options that a replay of the newest day appends, when it is run two times over."""
    lake, source = Lakehouse(w.spark, f"{w.root}/replayed"), w.snapshot()
    target = str(source + daily.dt.timedelta(days=1))
    daily.extract(lake, _source_items(w), _source_options(w), source, source)
    for _ in range(2):
        daily.replay_day(lake, source, daily.dt.date.fromisoformat(target), 2000, daily.dt.date.fromisoformat(target))
    columns = ["order_id", "lineitem_id", "name", "price", "quantity", "ingestion_date"]
    new_lines = lake.range("bronze_order_items", target, target).withColumnsRenamed({
        "item_name": "name", "item_price": "price", "item_quantity": "quantity"})
    new_options = lake.range("bronze_order_items_options", target, target).withColumnsRenamed({
        "option_name": "name", "option_price": "price", "option_quantity": "quantity"})
    return new_lines.select(F.lit("line").alias("kind"), *columns).unionAll(
        new_options.select(F.lit("option").alias("kind"), *columns))


@query
def catalog_mart(w):
    """The store-day mart of the last two days, written and read through a catalog table by day."""
    table = "gold_daily_sales_by_store"
    root = f"{w.root}/catalog/{daily.uuid.uuid4().hex[:8]}"
    full = catalog.create_table(w.spark, table, root, f"mart_{w.root.rsplit('/', 1)[-1]}")
    for back in (1, 0, 0):  # the newest day twice: its partition is replaced
        day = w.snapshot() - daily.dt.timedelta(days=back)
        catalog.insert_overwrite(w.g1().filter(F.col("order_date") == F.lit(day)), full)
        catalog.add_partition(w.spark, full, "order_date", str(day))
    return w.spark.table(full)


# --- views ------------------------------------------------------------------

@query
def sales_trends_daily(w):
    return views.sales_trends_daily(w.g1())


@query
def top_items_30d(w):
    return views.top_items_30d(w.g2())


@query
def loyalty_mix_daily(w):
    return views.loyalty_mix_daily(w.g1())


@query
def discounts_by_day(w):
    return views.discounts_daily(w.g4())


@query
def customer_facts_latest(w):
    return views.customer_facts_latest(w.g3())


@query
def category_mix_monthly_12m(w):
    return views.category_mix_monthly_12m(w.g2())


@query
def churn_risk_latest(w):
    return views.churn_risk_latest(w.g3())


@query
def customer_segments_latest(w):
    return views.customer_segments_latest(w.g3())


@query
def holiday_uplift_12m(w):
    return views.holiday_uplift_12m(w.g1(), w.dates(), w.n_days())


@query
def holiday_uplift_12m_literal(w):
    return views.holiday_uplift_12m(w.g1(), w.dates(), w.n_days(), literal=True)


@query
def location_performance_90d(w):
    return views.location_performance_90d(w.g1(), w.items())


@query
def loyalty_vs_nonloyalty(w):
    return views.loyalty_vs_nonloyalty(w.g3())


@query
def discount_effectiveness_30d(w):
    return views.discount_effectiveness_30d(w.g4())


@query
def sales_dow_store_12m(w):
    return views.sales_dow_store_12m(w.g1(), w.dates(), w.n_days())


@query
def sales_monthly_store_12m(w):
    return views.sales_monthly_store_12m(w.g1())


@query
def sales_with_holidays_daily(w):
    return views.sales_with_holidays_daily(w.g1(), w.dates(), w.n_days())


@query
def sales_monthly_category(w):
    return views.sales_monthly_category(w.g2())


@query
def sales_monthly_store(w):
    return views.sales_monthly_store(w.g1())


@query
def location_actions_90d(w):
    return views.location_actions_90d(w.g1(), w.items())


@query
def discount_summary_overall_12m(w):
    return views.discount_summary_overall_12m(w.g4())


@query
def discount_summary_store_12m(w):
    return views.discount_summary_store_12m(w.g4())


@query
def discount_orders_90d(w):
    newest = views.latest(w.g4())
    return views.discount_orders_90d(w.items(), w.options(), newest)


@query
def store_sales_latest(w):
    return views.store_sales_latest(w.g1())


@query
def item_sales_30d(w):
    return views.item_sales_30d(w.g2())


# --- metrics ----------------------------------------------------------------

@query
def date_bounds(w):
    return metrics.date_bounds(views.sales_trends_daily(w.g1()))


@query
def store_list(w):
    return metrics.store_list(views.sales_trends_daily(w.g1()))


@query
def daily_sales_matrix(w):
    trends = views.sales_trends_daily(w.g1())
    return metrics.store_day_matrix(trends, "gross_sales_total", STORES)


@query
def daily_sales_matrix_selection(w):
    """Two stores, the 29 days before the newest."""
    day = daily.dt.timedelta(days=1)
    return metrics.store_day_matrix(
        views.sales_trends_daily(w.g1()), "gross_sales_total", ["1", "7"],
        w.snapshot() - 29 * day, w.snapshot() - day)


@query
def daily_orders_matrix(w):
    trends = views.sales_trends_daily(w.g1())
    return metrics.store_day_matrix(trends, "orders_count", STORES)


@query
def latest_day_kpi(w):
    return metrics.latest_day_kpi(views.sales_trends_daily(w.g1()))


@query
def top_items_by_store(w):
    return metrics.top_items_by_store(views.item_sales_30d(w.g2()), 10)


@query
def loyalty_share_matrix(w):
    mix = views.loyalty_mix_daily(w.g1())
    return metrics.store_day_matrix(mix, "loyalty_orders_pct", STORES)


@query
def discount_share_matrix(w):
    discounts = views.discounts_daily(w.g4())
    return metrics.store_day_matrix(discounts, "pct_sales_discounted", STORES)


@query
def latest_discount_kpi(w):
    return metrics.latest_discount_kpi(views.discounts_daily(w.g4()))


@query
def top_customers(w):
    return metrics.top_customers(w.g3())


def _segments(w):
    return views.customer_segments_latest(w.g3())


@query
def segment_loyalty_counts(w):
    return metrics.segment_loyalty_counts(_segments(w))


@query
def segment_loyalty_matrix(w):
    return metrics.segment_loyalty_matrix(_segments(w))


@query
def top_spenders(w):
    return metrics.top_spenders(_segments(w))


@query
def segment_summary(w):
    return metrics.segment_summary(w.g3())


@query
def top_contributor(w):
    return metrics.top_contributor(w.g3())


def _churn(w):
    return views.churn_risk_latest(w.g3())


@query
def risk_counts(w):
    return metrics.risk_counts(_churn(w))


@query
def at_risk_customers(w):
    return metrics.at_risk_customers(_churn(w))


@query
def churn_medians(w):
    return metrics.churn_medians(_churn(w))


@query
def churn_activity(w):
    return metrics.churn_activity(_churn(w))


@query
def churn_high_vs_low(w):
    return metrics.churn_high_vs_low(_churn(w))


def _months(w):
    return views.sales_monthly_store_12m(w.g1())


@query
def last_months_change(w):
    return metrics.last_months_change(_months(w))


@query
def store_trend_12m(w):
    return metrics.store_trend_12m(_months(w))


@query
def best_mover(w):
    return metrics.best_mover(_months(w))


def _dow(w):
    return views.sales_dow_store_12m(w.g1(), w.dates(), w.n_days())


@query
def weekday_matrix(w):
    return metrics.weekday_matrix(_dow(w))


@query
def weekday_profile(w):
    return metrics.weekday_profile(_dow(w))


def _mix(w):
    return views.category_mix_monthly_12m(w.g2())


@query
def category_mix(w):
    return metrics.category_mix(_mix(w))


@query
def category_mix_matrix(w):
    wide = metrics.category_mix_matrix(_mix(w))
    return wide.withColumns({c: F.round(c, DIGITS) for c in wide.columns if c != "month"})


@query
def category_drift(w):
    return metrics.category_drift(_mix(w))


@query
def top_holiday_uplift(w):
    return metrics.top_holiday_uplift(
        views.holiday_uplift_12m(w.g1(), w.dates(), w.n_days())
    )


@query
def loyalty_impact_summary(w):
    return metrics.loyalty_impact_summary(w.g3())


@query
def loyalty_effect_sizes(w):
    return metrics.loyalty_effect_sizes(w.g3())


@query
def store_ranking_90d(w):
    return metrics.store_ranking_90d(views.location_actions_90d(w.g1(), w.items()))


@query
def discount_totals(w):
    return metrics.discount_totals(views.discount_summary_overall_12m(w.g4()))


@query
def store_net_ranking(w):
    return metrics.store_net_ranking(views.discount_summary_store_12m(w.g4()))


@query
def top_stores_gross_net(w):
    return metrics.top_stores_gross_net(views.discount_summary_store_12m(w.g4()))


# --- reports ----------------------------------------------------------------

@query
def report_sales_per_day(w):
    return reports.sales_per_day(w.g1())


@query
def report_store_leaderboard(w):
    return reports.store_leaderboard(w.g1())


@query
def report_top_items(w):
    return reports.top_items(views.item_sales_30d(w.g2()))


@query
def report_discounted_vs_full_price(w):
    return reports.discounted_vs_full_price(lines.orders_discount(w.enriched()))


@query
def report_loyalty_orders(w):
    return reports.loyalty_orders(w.g1())


@query
def report_segment_revenue(w):
    return reports.segment_revenue(w.g3())


@query
def report_month_weekday_sales(w):
    return reports.month_weekday_sales(w.g1(), w.dates(), w.n_days())


# --- registry ---------------------------------------------------------------

# Double columns whose sum order is not fixed are rounded on both sides.
ROUNDED: dict[str, list[str]] = {
    "latest_discount_kpi": ["pct"],
    "location_performance_90d": ["repeat_rate_90d"],
    "location_actions_90d": ["repeat_rate_90d"],
    "store_ranking_90d": ["repeat_rate_90d"],
    "store_trend_12m": ["avg_mom_last3"],
    "best_mover": ["avg_mom_last3"],
    "weekday_profile": ["mean_sales"],
    "category_mix": ["sales_share"],
    "category_drift": ["avg_share", "first3_share", "last3_share", "share_change"],
    "holiday_uplift_12m": ["uplift_pct"],
    "holiday_uplift_12m_literal": ["uplift_pct"],
    "top_holiday_uplift": ["uplift_pct"],
    "loyalty_effect_sizes": [
        "clv_uplift_pct", "aov_uplift_pct", "repeat_diff_pp", "customer_share_pct",
        "sales_share_pct"],
}


def all_queries() -> dict[str, Query]:
    def bind(name: str, build: Callable[[Workspace], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = build(Workspace(spark, sf_dir))
            return df.withColumns({c: F.round(c, DIGITS) for c in ROUNDED.get(name, [])})

        run.__name__ = name
        return run

    return {name: bind(name, build) for name, build in REGISTRY.items()}
