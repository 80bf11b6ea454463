import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from dinerlake.operators import quality as ql
from dinerlake.operators.lines import (
    enrich_lines, options_per_line, options_split_per_line, orders_by_store,
)
from dinerlake.plans import marts
from tests.helpers import day, items, line, option, options, rows

SNAP = day("2024-06-30")


def enriched(spark, lines, opts=(), **kw):
    opts = list(opts) or [option("none", "none")]
    return enrich_lines(items(spark, *lines), options(spark, *opts), **kw)


def test_options_are_summed_before_the_join(spark):
    opts = options(
        spark, option("a", "1", "x", "1.50", 2), option("a", "1", "y", "-1.00", 1),
        option("a", "2", "x", "2.00", 1),
    )
    assert rows(options_per_line(opts)) == [("a", "1", D("2.00")), ("a", "2", D("2.00"))]


def test_discount_sign_and_count_differ_for_negative_quantity(spark):
    opts = options(spark, option("a", "1", "x", "-2.00", -1), option("a", "1", "y", "-3.00", 1))
    assert rows(options_split_per_line(opts)) == [("a", "1", D("2.00"), D("-3.00"), 2)]


@pytest.mark.parametrize("unique", [True, False])
def test_line_totals_and_missing_options(spark, unique):
    e = enriched(
        spark, [line("a", "1", qty=2), line("a", "2")],
        [option("a", "1", "x", "3.00"), option("a", "1", "y", "-1.00"), option("z", "9")],
        unique_lines=unique,
    )
    assert rows(e, "lineitem_id", "line_total", "line_pre_total", "has_discount_line") == [
        ("1", D("22.00"), D("23.00"), True), ("2", D("10.00"), D("10.00"), False)]
    assert dict(e.dtypes)["line_total"] == "decimal(18,2)"


def test_null_line_key_matches_nothing(spark):
    e = enriched(spark, [line("a", None)], [option("a", None, "x", "3.00")])
    assert rows(e, "line_total") == [(D("10.00"),)]


def test_one_loyal_line_makes_the_order_loyal(spark):
    e = enriched(spark, [line("a", "1", loyal=True), line("a", "2"), line("b", "1", loyal=None)])
    assert rows(orders_by_store(e), "order_id", "is_loyalty_order") == [("a", True), ("b", False)]


def test_store_day_mart(spark):
    e = enriched(
        spark,
        [line("a", "1", loyal=True), line("a", "2", qty=3), line("b", "1", price="5.00")],
        [option("a", "1", "x", "-2.00")],
    )
    r = marts.daily_sales_by_store(e).first()
    assert (r.gross_sales_total, r.item_sales, r.option_sales) == (D("43.00"), D("45.00"), D("-2.00"))
    assert (r.orders_count, r.items_count) == (2, 5)
    assert (r.loyalty_sales, r.loyalty_orders) == (D("38.00"), 1)
    assert (r.non_loyalty_sales, r.non_loyalty_orders) == (D("5.00"), 1)


def test_discount_mart(spark):
    e = enriched(
        spark, [line("a", "1"), line("b", "1")],
        [option("a", "1", "x", "-2.00"), option("a", "1", "y", "4.00")],
    )
    r = marts.discounts_by_day(e).first()
    assert (r.orders_count, r.discounted_orders, r.count_discounts) == (2, 1, 1)
    assert (r.pre_discount_sales, r.discount_amount_abs) == (D("24.00"), D("2.00"))
    assert r.net_sales_after_discounts == D("22.00")
    assert r.pct_orders_discounted == 0.5 and r.pct_sales_discounted == pytest.approx(2 / 24)


def features(spark, lines, opts=()):
    df = marts.customer_features(enriched(spark, lines, opts), SNAP)
    return {r.user_id: r for r in df.collect()}


def back(n):
    return str(SNAP - dt.timedelta(days=n))


def test_ninety_day_windows(spark):
    lines = [line(f"o{n}", "1", back(n)) for n in (0, 89, 90, 179, 180)]
    r = features(spark, lines + [line("late", "1", str(SNAP + dt.timedelta(days=1)))])["u1"]
    assert (r.last_90d_orders_count, r.last_90d_sales, r.prev_90d_sales) == (
        2, D("20.00"), D("20.00"))
    assert r.lifetime_orders == 5 and r.delta_90d_pct == 0.0
    assert r.days_since_last_order == 0


def test_null_users_are_left_out(spark):
    assert set(features(spark, [line("a", "1", user=None), line("b", "1")])) == {"u1"}


def test_order_over_two_dates(spark):
    r = features(spark, [
        line("a", "1", back(10), loyal=True), line("a", "2", back(9), loyal=True),
        line("b", "1", back(4)),
    ])["u1"]
    assert (r.lifetime_orders, r.loyalty_orders, r.non_loyalty_orders) == (2, 2, 1)
    assert r.last_90d_orders_count == 2
    assert r.avg_interorder_gap_days == 3.0      # gaps 1 and 5 over three order rows


def test_single_order_has_no_gap_and_no_change(spark):
    r = features(spark, [line("a", "1", back(5))])["u1"]
    assert r.avg_interorder_gap_days is None and r.delta_90d_pct is None
    assert r.avg_order_value == D("10.0000")


def test_average_gap_equals_lag_average(spark, work):
    from pyspark.sql import Window

    from dinerlake.operators.lines import orders_by_user

    e = work.enriched()
    w = Window.partitionBy("user_id").orderBy("order_date")
    slow = orders_by_user(e).withColumn(
        "gap", F.datediff("order_date", F.lag("order_date").over(w))
    ).groupBy("user_id").agg(F.avg("gap").alias("gap"))
    fast = marts.customer_features(e, work.snapshot())
    gap = fast.join(slow, "user_id").filter(
        ~F.col("avg_interorder_gap_days").eqNullSafe(F.col("gap")))
    assert gap.count() == 0


def scored(spark, *values):
    """values: (user, days, orders, sales, lifetime)"""
    df = spark.createDataFrame(
        [(u, d, o, D(s), D(v)) for u, d, o, s, v in values],
        "user_id string, days_since_last_order int, last_90d_orders_count bigint,"
        " last_90d_sales decimal(18,2), lifetime_gross_sales decimal(18,2)",
    )
    return {r.user_id: r for r in marts.rfm_scores(df).collect()}


def test_scores_bands_and_segments(spark):
    got = scored(spark, *[(f"u{i}", i * 10, i, str(i * 100), str(i * 100)) for i in range(1, 11)])
    assert [got[f"u{i}"].recency_score for i in range(1, 11)] == [5, 5, 4, 4, 3, 3, 2, 2, 1, 1]
    assert [got[f"u{i}"].monetary_score for i in range(1, 11)] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert [got[f"u{i}"].clv_band for i in (1, 2, 7, 8, 10)] == [
        "Low", "Medium", "Medium", "High", "High"]
    assert got["u10"].segment_label == "Churn-risk"      # recency is tested before value
    assert got["u1"].segment_label == "Standard"


def test_vip_and_high_value(spark):
    best = [("v", 1, 9, "900", "900"), ("h", 30, 9, "900", "900")]
    rest = [(f"r{i}", d, 1, "1", "1") for i, d in enumerate((10, 20, 40, 50, 60, 70, 80, 90))]
    got = scored(spark, *best, *rest)
    assert got["v"].segment_label == "VIP"
    assert got["h"].recency_score == 4 or got["h"].segment_label == "High-Value"


def test_ties_skip_scores(spark):
    got = scored(spark, *[(f"u{i}", 1, 0 if i < 7 else i, "1", "1") for i in range(10)])
    assert sorted({r.frequency_score for r in got.values()}) == [1, 4, 5]


def test_invariants_on_sample_tables(work):
    g1, g2, g4 = work.g1(), work.g2(), work.g4()
    assert ql.reconcile_items(g2).first().max_diff == 0
    check = ql.reconcile_discounts(g4).first()
    assert check.max_diff == 0 and check.min_gap >= 0
    assert ql.cross_check_marts(g4, g1).agg(F.max("diff")).first()[0] == 0
    assert ql.cross_check_marts(g4, g1).count() == g1.count() == g4.count()
    split = g1.filter(
        "loyalty_sales + non_loyalty_sales <> gross_sales_total"
        " or loyalty_orders + non_loyalty_orders <> orders_count")
    assert split.count() == 0
    key = ["restaurant_id", "order_date"]
    items_total = g2.groupBy(*key).agg(F.sum("sales_total").alias("total"))
    assert g1.join(items_total, key).filter("total <> gross_sales_total").count() == 0
    assert g1.join(items_total, key).count() == g1.count()


def test_mart_schemas(work):
    from dinerlake.schemas import schema_of

    for table, df in (
        ("gold_daily_sales_by_store", work.g1()), ("gold_item_sales_by_day", work.g2()),
        ("gold_customer_facts", work.g3()), ("gold_discounts_by_day", work.g4()),
    ):
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in schema_of(table)]
