import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from dinerlake.plans import metrics, reports, views
from tests.helpers import day, items, line, mart, option, options, rows

G1, G2, G3, G4 = (
    "gold_daily_sales_by_store", "gold_item_sales_by_day", "gold_customer_facts",
    "gold_discounts_by_day",
)


def g1(spark, *triples):
    """(store, date, gross)"""
    return mart(spark, G1, *[
        dict(restaurant_id=s, order_date=day(d), gross_sales_total=D(x), orders_count=2,
             items_count=3, loyalty_sales=D(x) / 2, non_loyalty_sales=D(x) / 2,
             loyalty_orders=1, non_loyalty_orders=1)
        for s, d, x in triples])


def g2(spark, *rows_):
    """(store, date, category, name, sales)"""
    return mart(spark, G2, *[
        dict(restaurant_id=s, order_date=day(d), item_category=c, item_name=n,
             units_sold=1, sales_total=D(x)) for s, d, c, n, x in rows_])


def customer(user, **kw):
    base = dict(
        user_id=user, snapshot_date=day("2024-06-30"), loyalty_orders=0, lifetime_orders=1,
        last_90d_orders_count=1, last_90d_sales=D("10.00"), prev_90d_sales=D("0.00"),
        lifetime_gross_sales=D("10.00"), avg_order_value=D("10.00"), recency_score=5,
        frequency_score=3, monetary_score=3, days_since_last_order=1, segment_label="Standard")
    return base | kw


def dates(spark, start, end, *holidays):
    from dinerlake.operators.calendar import date_dim

    named = spark.createDataFrame(
        [(day(d), n) for d, n in holidays], "date_key date, holiday_name string")
    return date_dim(spark, day(start), day(end), named)


def test_trends_window_and_zero_guards(spark):
    mart_ = g1(spark, ("1", "2024-06-30", "10.00"), ("1", "2024-04-01", "4.00"),
               ("1", "2024-03-31", "9.00"), ("2", "2024-06-30", "0.00"))
    got = rows(views.sales_trends_daily(mart_), "restaurant_id", "order_date",
               "avg_order_value", "loyalty_sales_pct")
    assert got == [("1", day("2024-04-01"), 2.0, 0.5), ("1", day("2024-06-30"), 5.0, 0.5),
                   ("2", day("2024-06-30"), 0.0, 0.0)]


def test_top_items_ties_are_settled(spark):
    mart_ = g2(spark, ("1", "2024-06-30", "B", "x", "5.00"), ("1", "2024-06-30", "A", "y", "5.00"),
               ("1", "2024-06-01", None, "z", "5.00"), ("1", "2024-05-31", "A", "old", "99.00"))
    assert rows(views.top_items_30d(mart_), "rn_store", "item_name") == [(1, "y"), (2, "x"), (3, "z")]
    top = metrics.top_items_by_store(views.item_sales_30d(mart_), 2)
    assert rows(top, "rn_store", "item_name") == [(1, "y"), (2, "x")]


def test_month_change(spark):
    mart_ = g1(spark, ("1", "2024-01-05", "10.00"), ("1", "2024-02-05", "15.00"),
               ("2", "2024-02-05", "0.00"), ("2", "2024-03-05", "3.00"))
    assert [r[2] for r in rows(views.sales_monthly_store_12m(mart_), "restaurant_id", "month",
                               "mom_pct")] == [None, 0.5, None, None]


def test_category_share_sums_to_one(spark):
    mart_ = g2(spark, ("1", "2024-06-30", "A", "x", "1.00"), ("1", "2024-06-02", "B", "y", "3.00"))
    assert rows(views.category_mix_monthly_12m(mart_), "item_category", "sales_share") == [
        ("A", 0.25), ("B", 0.75)]


@pytest.fixture(scope="module")
def holiday_case(spark):
    # Mondays: 6, 13, 20 and 27 May 2024; the 27th is a holiday.
    sales = g1(spark, ("1", "2024-05-06", "10.00"), ("1", "2024-05-13", "20.00"),
               ("1", "2024-05-20", "30.00"), ("1", "2024-05-27", "40.00"),
               ("1", "2024-05-28", "1.00"))
    return sales, dates(spark, "2024-05-01", "2024-05-31", ("2024-05-27", "Memorial Day"),
                        ("2024-05-28", "No baseline"))


def test_holiday_uplift_counts_the_holiday_once(holiday_case):
    r = views.holiday_uplift_12m(*holiday_case).collect()
    assert len(r) == 1      # the second holiday has no plain Tuesday to compare with
    assert (r[0].holiday_sales, r[0].baseline_sales, r[0].uplift_pct) == (D("40.00"), D("20.00"), 1.0)


def test_holiday_uplift_literal_fan_out(holiday_case):
    r = views.holiday_uplift_12m(*holiday_case, literal=True).first()
    assert (r.holiday_sales, r.baseline_sales, r.uplift_pct) == (D("120.00"), D("20.00"), 5.0)


def test_location_counts_unknown_users_in_the_rate_only(spark):
    lines = items(spark, line("a", "1", user=None), line("b", "1", user=None),
                  line("c", "1", user="u1"), line("c", "2", user="u1"))
    mart_ = g1(spark, ("1", "2024-01-10", "40.00"), ("2", "2024-01-10", "1.00"))
    got = {r.restaurant_id: r for r in views.location_performance_90d(mart_, lines).collect()}
    assert (got["1"].customers_90d, got["1"].repeat_rate_90d, got["1"].aov_90d) == (1, 0.5, D("20.00"))
    assert (got["2"].customers_90d, got["2"].repeat_rate_90d) == (0, 0.0)


def test_location_actions(spark):
    lines = items(spark, line("a", "1"))
    mart_ = g1(spark, ("1", "2023-12-10", "100.00"), ("1", "2024-01-10", "40.00"))
    r = views.location_actions_90d(mart_, lines).first()
    assert (r.loyalty_order_share, r.last_mom_pct) == (0.5, -0.6)
    assert r.recommendations == "win back one-time customers; review the recent decline"


def test_churn_rules_with_missing_change(spark):
    cases = [
        customer("recent"),
        customer("low_r", recency_score=2),
        customer("days46", days_since_last_order=46),
        customer("days31", days_since_last_order=31),
        customer("lapsed", last_90d_orders_count=0, prev_90d_sales=D("5.00")),
        customer("half", delta_90d_pct=-0.5),
        customer("quarter", delta_90d_pct=-0.25),
        customer("old", snapshot_date=day("2024-06-29"), recency_score=1),
    ]
    view = views.churn_risk_latest(mart(spark, G3, *cases))
    assert dict(rows(view, "user_id", "risk_level")) == {
        "recent": "Low", "low_r": "High", "days46": "High", "days31": "Medium",
        "lapsed": "High", "half": "High", "quarter": "Medium"}


def test_loyalty_comparison(spark):
    facts = mart(
        spark, G3,
        customer("a", loyalty_orders=1, lifetime_orders=2, lifetime_gross_sales=D("30.00")),
        customer("b", lifetime_gross_sales=D("10.00")),
        customer("c", lifetime_gross_sales=D("20.01")))
    got = {r.is_loyalty_member: r for r in views.loyalty_vs_nonloyalty(facts).collect()}
    assert (got[True].avg_clv, got[True].repeat_rate) == (D("30.00"), 1.0)
    assert got[False].avg_clv == D("15.01")      # 15.005 rounds up
    effect = metrics.loyalty_effect_sizes(facts).first()
    assert effect.repeat_diff_pp == 100.0
    assert effect.customer_share_pct == pytest.approx(100 / 3)
    only = mart(spark, G3, customer("b"))
    assert metrics.loyalty_effect_sizes(only).count() == 0


def test_discount_share_is_a_true_ratio(spark):
    mart_ = mart(spark, G4, *[dict(
        restaurant_id="1", order_date=day("2024-06-30"), orders_count=4, discounted_orders=1,
        count_discounts=1, discount_amount_abs=D("1.00"), pre_discount_sales=D("8.00"),
        net_sales_after_discounts=D("7.00"), pct_orders_discounted=0.25,
        pct_sales_discounted=0.125)])
    assert views.discount_effectiveness_30d(mart_).first().pct_orders_discounted_30d == 0.25
    total = views.discount_summary_overall_12m(mart_).first()
    assert (total.discount_rate, total.discounted_order_share) == (0.125, 0.25)
    assert (total.aov_gross, total.aov_net) == (D("2.00"), D("1.75"))


def test_discount_orders_anchor(spark):
    lines = items(spark, line("a", "1", "2024-06-30"), line("b", "1", "2024-03-31"),
                  line("c", "1", "2024-04-01"))
    opts = options(spark, option("a", "1", "x", "-2.00"), option("b", "1", "x", "-2.00"))
    got = views.discount_orders_90d(lines, opts)
    assert rows(got, "order_id", "has_discount_order") == [("a", True), ("c", False)]


def test_matrix_has_every_chosen_store(spark):
    trends = views.sales_trends_daily(g1(
        spark, ("1", "2024-06-29", "1.00"), ("1", "2024-06-30", "2.00"), ("3", "2024-06-30", "3.00")))
    wide = metrics.store_day_matrix(trends, "gross_sales_total", ["1", "2"])
    assert wide.columns == ["order_date", "store_1", "store_2"]
    assert rows(wide) == [(day("2024-06-29"), 1.0, None), (day("2024-06-30"), 2.0, None)]
    one = metrics.store_day_matrix(trends, "gross_sales_total", ["1"], end=day("2024-06-29"))
    assert one.count() == 1


def test_latest_day_is_per_store(spark):
    trends = views.sales_trends_daily(g1(
        spark, ("1", "2024-06-29", "1.00"), ("2", "2024-06-30", "2.00"), ("2", "2024-06-28", "9.00")))
    assert rows(metrics.latest_day_kpi(trends), "restaurant_id", "order_date", "gross", "aov") == [
        ("1", day("2024-06-29"), D("1.00"), 0.5), ("2", day("2024-06-30"), D("2.00"), 1.0)]


def test_store_trend_words(spark):
    mart_ = g1(spark,
               ("up", "2024-01-05", "10.00"), ("up", "2024-04-05", "20.00"),
               ("down", "2024-01-05", "10.00"), ("down", "2024-04-05", "9.00"),
               ("flat", "2024-01-05", "10.00"), ("flat", "2024-04-05", "10.50"),
               ("none", "2024-01-05", "0.00"), ("none", "2024-04-05", "5.00"))
    months = views.sales_monthly_store_12m(mart_)
    words = dict(rows(metrics.store_trend_12m(months), "restaurant_id", "direction"))
    assert words == {"up": "rising", "down": "declining", "flat": "flat", "none": "mixed"}
    assert metrics.best_mover(months).first().restaurant_id == "up"
    last = metrics.last_months_change(months, 1)
    assert ("down", -10.0) in rows(last, "restaurant_id", "mom_pct")


def test_category_drift_uses_months_not_rows(spark):
    data = [("1", f"2024-0{m}-15", "A", "x", str(10 * m)) for m in range(1, 7)]
    data += [(s, f"2024-0{m}-15", "B", "y", "10.00") for m in range(1, 7) for s in ("1", "2")]
    drift = metrics.category_drift(views.category_mix_monthly_12m(g2(spark, *data)))
    a = {r.item_category: r for r in drift.collect()}["A"]
    shares = [10 * m / (10 * m + 10) for m in range(1, 7)]
    assert a.first3_share == pytest.approx(sum(shares[:3]) / 3)
    assert a.last3_share == pytest.approx(sum(shares[3:]) / 3)
    assert a.direction == "rising"


def test_weekday_profile(spark):
    dow = spark.createDataFrame(
        [("1", "Monday", D("5.00")), ("2", "Monday", D("7.00")), ("1", "Sunday", D("9.00")),
         ("1", "Friday", D("1.00"))],
        "restaurant_id string, day_of_week string, avg_sales_dow decimal(18,2)")
    assert rows(metrics.weekday_profile(dow)) == [
        ("Friday", 1.0, 3, "lowest"), ("Monday", 6.0, 2, "second"), ("Sunday", 9.0, 1, "highest")]


def test_segment_summary_shares(spark):
    facts = mart(spark, G3, customer("a", segment_label="VIP", last_90d_sales=D("30.00")),
                 customer("b"), customer("c", last_90d_sales=D("0.00")))
    got = {r.segment_label: r for r in metrics.segment_summary(facts).collect()}
    assert got["VIP"].customer_share == pytest.approx(1 / 3)
    assert got["VIP"].sales_share == 0.75
    assert metrics.top_contributor(facts).first().segment_label == "VIP"


def test_high_vs_low_without_a_level(spark):
    churn = views.churn_risk_latest(mart(spark, G3, customer("a")))
    r = metrics.churn_high_vs_low(churn).first()
    assert r.high_p50_days_since_last is None and r.low_p50_days_since_last == 1
    assert (r.n_high, r.n_medium, r.n_low) == (0, 0, 1)


def test_report_loyalty_rows(spark):
    got = {r.is_loyalty: r for r in reports.loyalty_orders(
        g1(spark, ("1", "2024-06-30", "10.00"))).collect()}
    assert got[True].avg_order_value == D("5.00") and got[False].orders == 1


def test_discounted_and_full_price_add_up(work):
    from dinerlake.operators.lines import orders_discount

    split = reports.discounted_vs_full_price(orders_discount(work.enriched()))
    per_day = reports.sales_per_day(work.g1())
    gap = split.join(per_day, "order_date").filter(
        F.col("discounted_sales") + F.col("full_price_sales") != F.col("sales"))
    assert gap.count() == 0 and split.count() == per_day.count()


def test_latest_anchor_is_the_newest_date(spark):
    newest = dt.date(2024, 6, 30)
    mart_ = g1(spark, ("1", "2024-06-30", "1.00"), ("1", "2024-06-29", "2.00"))
    assert [r.order_date for r in views.store_sales_latest(mart_).collect()] == [newest]


def test_matrix_takes_its_columns_from_the_data(spark):
    rows = [("1", day("2024-06-28"), 10.0), ("2", day("2024-06-28"), 20.0)]
    schema = "restaurant_id string, order_date date, gross_sales_total double"
    assert metrics.store_day_matrix(spark.createDataFrame(rows, schema), "gross_sales_total").columns == [
        "order_date", "store_1", "store_2"]
    rows.append(("77", day("2024-06-29"), 5.0))
    wide = metrics.store_day_matrix(spark.createDataFrame(rows, schema), "gross_sales_total")
    assert wide.columns == ["order_date", "store_1", "store_2", "store_77"]
