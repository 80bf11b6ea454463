"""The plans have the shape that large tables need."""

import datetime as dt
import re

from pyspark.sql import functions as F

from dinerlake.operators import lines
from dinerlake.operators.joins import join_to_unique
from dinerlake.operators.lines import enrich_lines
from dinerlake.operators.dedupe import dedupe_items
from dinerlake.plans import marts, silver, views
from dinerlake.sources import files
from dinerlake.sources import sample_tables as st
from tests import helpers as H
from tests.conftest import SMALL


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_are_scanned(spark):
    e = enrich_lines(st.order_items(spark, SMALL), st.options(spark, SMALL))
    plan = physical(marts.daily_sales_by_store(e))
    scans = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert any("l_quantity" in s for s in scans)
    for unused in ("l_shipdate", "l_extendedprice", "o_totalprice", "c_acctbal", "p_name"):
        assert not any(unused in s for s in scans)


def test_day_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "items")
    files.write_plain(st.order_items(spark, SMALL), path)
    chosen = silver.items_of_days(
        files.read_table(spark, path), dt.date(2000, 1, 1), dt.date(2000, 1, 1))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", physical(chosen)).group(1)
    assert "GreaterThanOrEqual(creation_time_utc" in pushed
    assert "LessThan(creation_time_utc" in pushed


def test_rolling_window_prunes_partitions(spark, work, tmp_path):
    path = str(tmp_path / "g1")
    files.overwrite_partitions(
        work.g1().filter("order_date >= date'2001-01-01'"), path, "order_date")
    view = views.sales_trends_daily(files.read_table(spark, path))
    plan = physical(view)
    filters = re.findall(r"PartitionFilters: \[(.*)", plan)
    assert any("order_date" in f and "ubquery" in f for f in filters)


def test_dedupe_limits_groups_before_the_shuffle(work):
    plan = physical(dedupe_items(work.items()))
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("Exchange hashpartitioning") < partial      # printed top down


def test_customer_facts_has_no_single_partition_window_or_product(work):
    facts = marts.customer_facts(work.enriched(), work.snapshot())
    plan = physical(facts)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    # The only window ranks the values inside the quantile brackets, per quantile.
    windows = re.findall(r"Window \[.*?\], \[(.*?)\]", plan)
    assert all(w.startswith("target") for w in windows)


def test_marts_use_no_python(work):
    for df in (
        marts.daily_sales_by_store(work.enriched()), marts.item_sales_by_day(work.enriched()),
        marts.discounts_by_day(work.enriched()), silver.judged_items(work.raw_items()),
    ):
        plan = physical(df)
        assert "Python" not in plan and "ArrowEval" not in plan and "Expand" not in plan


def hot_tables(spark, n=120_000):
    """A third of the lines are copies of one line."""
    hot = F.col("id") % 3 == 0
    order = F.when(hot, F.lit("hot")).otherwise((F.col("id") / 4).cast("int").cast("string"))
    item = F.when(hot, F.lit("1")).otherwise((F.col("id") % 4).cast("string"))
    total = (F.abs(F.xxhash64("id")) % 1_000_000).cast("decimal(12,2)")
    lines = spark.range(0, n, 1, 12).select(
        order.alias("order_id"), item.alias("lineitem_id"), F.lit("7").alias("restaurant_id"),
        F.lit(dt.date(2024, 1, 1)).alias("order_date"), F.lit(1).alias("item_quantity"),
        total.alias("order_total"), F.lit(False).alias("is_loyalty"))
    options = spark.range(0, n, 1, 12).select(
        order.alias("order_id"), item.alias("lineitem_id"),
        F.lit(1).cast("decimal(10,2)").alias("option_price"), F.lit(1).alias("option_quantity"))
    return lines, options


def test_hot_line_is_split_over_tasks(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        lines, options = hot_tables(spark)
        mart = marts.daily_sales_by_store(enrich_lines(lines, options))
        row = mart.collect()[0]
        assert "SortMergeJoin(skew=true)" in physical(mart)
        expected = lines.agg(F.sum("order_total")).first()[0]
        # Every copy of the hot line carries the hot line's options.
        copies = lines.filter("order_id = 'hot'").count()
        matched = lines.count() - copies
        assert row.option_sales == copies * copies + matched
        assert row.item_sales == expected
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles(df):
    """What is dealt out by hash in the plan, by its keys without their numbers."""
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", physical(df))
    return [re.sub(r"#\d+L?", "", k) for k in keys]


def test_marts_of_the_sample_tables_deal_out_lines_once(work):
    """The join with the options and the roll-ups to orders use the layout by order."""
    clustered = work.enriched()
    for orders in (lines.orders_by_store, lines.orders_by_user, lines.orders_discount):
        assert shuffles(orders(clustered)) == ["order_id"] * 4
    assert "REBALANCE" not in physical(marts.daily_sales_by_store(clustered))


def test_clustered_lines_equal_those_dealt_out_anew(spark):
    one = [H.line("1", "1"), H.line("1", "1", price="2.00"), H.line(None, "1"), H.line("2", None), H.line("3", "1")]
    two = [H.option("1", "1"), H.option("1", "1"), H.option(None, "1"), H.option("2", None), H.option("2", "1")]
    items, options = H.items(spark, *one), H.options(spark, *two)
    plain = enrich_lines(items, options)
    near = enrich_lines(items.repartition("order_id"), options.repartition("order_id"), clustered=True)
    assert sorted(map(str, plain.collect())) == sorted(map(str, near.collect()))
    assert sorted(r.options_total for r in plain.collect()) == [0, 0, 0, 2, 2]


def test_order_range_is_that_of_the_lines(work):
    first, last = work.items().agg(F.min("order_date"), F.max("order_date")).first()
    assert work.date_range() == (first, last)


def test_layouts_by_some_keys_are_not_reused_for_unique_sides(spark, work):
    """Under the settings of the workspace both sides still get shuffles of their own."""
    rows = spark.range(100).select(F.col("id").alias("a"), (F.col("id") % 3).alias("b"))
    joined = join_to_unique(rows, rows.groupBy("a", "b").agg(F.count("a").alias("n")), ["a", "b"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert [k.split(",")[0] for k in shuffles(joined)].count("_key_hash") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joined.count() == 100 and joined.filter("n = 1").count() == 100


def test_delivery_is_written_where_it_is_judged(spark, tmp_path):
    """No rows are gathered by verdict; partitions that are listed and empty still go."""
    from dinerlake.plans.delivery import _stored

    rows = spark.range(40).select("id", F.when(F.col("id") % 2 == 0, "clean").otherwise("rejected").alias("verdict"))
    path = str(tmp_path / "judged")
    _stored(rows.repartition(4), path)
    assert len(list((tmp_path / "judged" / "verdict=clean").glob("*.parquet"))) > 1
    assert _stored(rows.filter("verdict = 'clean'"), path).count() == 20


def test_copies_are_written_without_gathering(spark, monkeypatch):
    from verification import workspace

    seen = []
    monkeypatch.setattr(workspace, "_written", set())
    monkeypatch.setattr(workspace, "write_plain", lambda df, path: seen.append(df))
    monkeypatch.setattr(spark.read.__class__, "parquet", lambda self, *p: None)
    w = workspace.Workspace(spark, SMALL)
    w._copy("items", lambda: spark.range(3))
    assert "rebalance" not in seen[0]._jdf.queryExecution().analyzed().toString().lower()


def test_scans_are_cut_unless_the_session_says_how(spark):
    from dinerlake.session import scan_in_parts

    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        for size, found in (("32m", "32m"), ("64m", "32m")):
            scan_in_parts(spark, size)
            assert spark.conf.get(key) == found
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
