import datetime as dt

import pytest
from pyspark.sql import functions as F

from dinerlake.operators.quality import QualityError
from dinerlake.sources import files
from dinerlake.sources.lakehouse import Lakehouse
from dinerlake.streaming import daily
from tests.helpers import day, items, line, option, options, rows

D1, D2, D3 = "2024-01-10", "2024-01-11", "2024-01-12"
SOURCE_ITEMS = [
    "app_name", "restaurant_id", "creation_time_utc", "order_id", "user_id",
    "printed_card_number", "is_loyalty", "currency", "lineitem_id", "item_category",
    "item_name", "item_price", "item_quantity"]
MARTS = [*daily.DAY_MARTS]


@pytest.fixture
def lake(spark, tmp_path):
    return Lakehouse(spark, str(tmp_path / "lake"))


@pytest.fixture(scope="module")
def source(spark):
    lines = items(
        spark, line("a", "1", D1), line("a", "1", D1), line("a", "2", D1, loyal=True),
        line("b", "1", D2, store="2", user=None), line("c", "1", D2), line("c", "2", D3),
        line("d", "1", D3, price="7.00", qty=2))
    opts = options(
        spark, option("a", "1", "x", "-1.00"), option("c", "1", "x", "2.00"),
        option("c", "2", "x", "3.00"), option("zz", "1", "x", "9.00"))
    return lines.select(*SOURCE_ITEMS), opts.drop("ingestion_date")


def tables(lake, names=MARTS):
    return {t: rows(lake.read(t)) for t in names}


def test_day_run_twice_gives_the_same_tables(lake, source):
    assert daily.run_day(lake, *source, day(D1))
    first = tables(lake, [*MARTS, "gold_customer_facts", "silver_order_items"])
    assert daily.run_day(lake, *source, day(D1))
    assert tables(lake, [*MARTS, "gold_customer_facts", "silver_order_items"]) == first
    assert lake.read("silver_order_items").count() == 2


def test_order_of_days_does_not_matter(spark, source, tmp_path):
    results = []
    for name, order in (("up", [D1, D2, D3]), ("down", [D3, D2, D1])):
        lake = Lakehouse(spark, str(tmp_path / name))
        for d in order:
            daily.run_day(lake, *source, day(d), snapshot=False)
        results.append(tables(lake))
    lake = Lakehouse(spark, str(tmp_path / "range"))
    daily.run_days(lake, *source, day(D1), day(D3), snapshot=False)
    results.append(tables(lake))
    before = tables(lake)
    daily.full_refresh(lake)
    assert tables(lake) == before
    assert results[0] == results[1] == results[2]
    assert len(results[0]["gold_daily_sales_by_store"]) == 4


def test_options_follow_their_order(lake, source):
    daily.extract(lake, *source, day(D2), day(D2))
    got = rows(lake.read("bronze_order_items_options"), "order_id", "lineitem_id")
    assert got == [("c", "1"), ("c", "2")]      # the whole order, not other orders


def test_empty_day_is_a_success_without_writes(lake, source):
    assert daily.run_day(lake, *source, day("2030-01-01")) is False
    assert lake.find("silver_order_items") is None
    with pytest.raises(QualityError):
        lake.read("gold_daily_sales_by_store")


def test_late_row_is_picked_up(spark, lake, source):
    lines, opts = source
    daily.run_days(lake, lines, opts, day(D1), day(D2))
    before = {r.order_date: r.orders_count for r in lake.read(MARTS[0]).filter(
        "restaurant_id = '1'").collect()}
    late = lines.unionByName(items(spark, line("late", "1", D1)).select(*SOURCE_ITEMS))
    daily.run_day(lake, late, opts, day(D1))
    after = {r.order_date: r.orders_count for r in lake.read(MARTS[0]).filter(
        "restaurant_id = '1'").collect()}
    assert after[day(D1)] == before[day(D1)] + 1 and after[day(D2)] == before[day(D2)]


def test_newest_version_of_a_line_wins(spark, lake):
    silver = items(
        spark, line("a", "1", D1, price="5.00", ingested=D1),
        line("a", "1", D1, price="6.00", ingested=D2), line("b", "1", D1, ingested=D1))
    lake.replace_partitions("silver_order_items", silver)
    lake.replace_partitions("silver_order_items_options", options(
        spark, option("a", "1", "x", "1.00", ingested=D1),
        option("a", "1", "x", "2.00", ingested=D2)))
    daily.build_day_marts(lake, day(D2), day(D2))
    assert str(lake.read(MARTS[0]).first().gross_sales_total) == "18.00"
    daily.compact(lake)
    assert rows(lake.read("silver_order_items"), "order_id", F.col("item_price").cast("string")) == [
        ("a", "6.00"), ("b", "10.00")]
    assert lake.read("silver_order_items_options").count() == 1


def test_snapshot_needs_rows(spark, lake):
    lake.replace_partitions("silver_order_items", items(spark, line("a", "1", D1)))
    lake.replace_partitions("silver_order_items_options", options(spark, option("a", "1")))
    assert daily.build_snapshot(lake) == day(D1)
    empty = Lakehouse(spark, lake.root + "_empty")
    with pytest.raises(QualityError):
        daily.build_snapshot(empty)


def test_snapshots_are_kept_side_by_side(lake, source):
    daily.run_days(lake, *source, day(D1), day(D3))
    daily.build_snapshot(lake, day(D1))
    facts = lake.read("gold_customer_facts")
    assert rows(facts, "snapshot_date", "lifetime_orders") == [(day(D1), 1), (day(D3), 3)]


def test_swap_write_over_its_own_input(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_plain(spark.range(10).toDF("x"), path)
    files.swap_write(files.read_table(spark, path).filter("x < 4"), path)
    assert files.read_table(spark, path).count() == 4
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_failed_swap_keeps_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_plain(spark.range(3).toDF("x"), path)
    bad = files.read_table(spark, path).select(F.raise_error(F.lit("stop")).alias("x"))
    with pytest.raises(Exception):
        files.swap_write(bad, path)
    assert files.read_table(spark, path).count() == 3


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "x int, p string"
    files.overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], schema), path, "p")
    files.overwrite_partitions(spark.createDataFrame([(3, "b")], schema), path, "p")
    files.append_partitions(spark.createDataFrame([(5, "a")], schema), path, "p")
    assert rows(files.read_table(spark, path), "p", "x") == [("a", 1), ("a", 5), ("b", 3)]
    files.overwrite_partitions(spark.createDataFrame([(6, "c")], schema), path, "p", ["a", "c", "z"])
    assert rows(files.read_table(spark, path), "p", "x") == [("b", 3), ("c", 6)]


def test_single_partition_read(spark, tmp_path):
    path = str(tmp_path / "t")
    assert files.read_partitions(spark, path, "p", "a") is None
    files.overwrite_partitions(
        spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string"), path, "p")
    assert rows(files.read_partitions(spark, path, "p", "a"), "x") == [(1,)]
    assert files.read_partitions(spark, path, "p", "z") is None


def test_schema_merge_read(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(1).toDF("x").write.parquet(str(path / "p=1"))
    spark.range(1).selectExpr("id as x", "'n' as y").write.parquet(str(path / "p=2"))
    assert set(files.read_merged(spark, str(path)).columns) == {"x", "y", "p"}


def test_dates_are_refreshed_in_place(spark, lake):
    none = spark.createDataFrame([], "date_key date, holiday_name string")
    one = spark.createDataFrame([(day(D2), "Fair")], none.schema)
    daily.refresh_dates(lake, day(D1), day(D3), none, ["date_key"])
    daily.refresh_dates(lake, day(D2), day(D2), one, ["date_key"])
    got = rows(lake.read("silver_date_dim"), "date_key", "is_holiday")
    assert got == [(day(D1), False), (day(D2), True), (day(D3), False)]
    daily.rewrite_bronze_dates(lake, lake.read("silver_date_dim"))
    bronze = lake.read("bronze_date_dim")
    assert bronze.filter("cast(date_key as string) <> ingestion_date").count() == 0


def test_replay_moves_lines_and_brings_options(lake, source):
    daily.run_days(lake, *source, day(D1), day(D3), snapshot=False)
    target = dt.date(2024, 2, 1)
    daily.replay_day(lake, day(D1), target, 1, target)
    new = lake.days("bronze_order_items", str(target))
    assert rows(new, "order_id", "lineitem_id") == [("a@2024-02-01", "1")]
    assert new.first().creation_time_utc == dt.datetime(2024, 2, 1, 12, 30)
    assert rows(lake.days("bronze_order_items_options", str(target)), "order_id") == [("a@2024-02-01",)]
    daily.refine(lake, target, target)
    daily.build_day_marts(lake, target, target)
    assert lake.read(MARTS[0]).filter(F.col("order_date") == F.lit(target)).count() == 1
    before = tables(lake)
    daily.compact(lake)
    daily.full_refresh(lake)
    assert tables(lake) == before      # the replayed order is one of its own


def gross(lake):
    return {str(r.order_date): (str(r.gross_sales_total), str(r.option_sales))
            for r in lake.read(MARTS[0]).collect()}


def test_rerun_removes_what_the_source_no_longer_has(spark, lake):
    lines = items(spark, line("a", "1", D1), line("b", "1", D2)).select(*SOURCE_ITEMS)
    opts = options(spark, option("a", "1", "x", "1.00")).drop("ingestion_date")
    daily.run_days(lake, lines, opts, day(D1), day(D2))
    assert gross(lake) == {D1: ("11.00", "1.00"), D2: ("10.00", "0.00")}
    daily.run_day(lake, lines, opts.limit(0), day(D1))
    assert gross(lake) == {D1: ("10.00", "0.00"), D2: ("10.00", "0.00")}
    assert daily.run_day(lake, lines.limit(0), opts, day(D1))
    assert gross(lake) == {D2: ("10.00", "0.00")}
    assert lake.days("silver_order_items", day(D1)) is None
    assert daily.run_day(lake, lines.limit(0), opts, day(D1)) is False


def test_a_moved_line_counts_once_before_and_after_compaction(spark, lake):
    first = items(spark, line("a", "1", D1), line("b", "1", D1)).select(*SOURCE_ITEMS)
    opts = options(spark).drop("ingestion_date")
    daily.run_day(lake, first, opts, day(D1))
    moved = items(spark, line("a", "1", D2, price="12.00")).select(*SOURCE_ITEMS)
    daily.run_day(lake, moved, opts, day(D2))
    want = {D1: ("10.00", "0.00"), D2: ("12.00", "0.00")}
    assert gross(lake) == want
    lifetime = lake.days("gold_customer_facts", day(D2)).first().lifetime_gross_sales
    daily.full_refresh(lake)
    assert gross(lake) == want and str(lifetime) == "22.00"
    daily.compact(lake)
    daily.full_refresh(lake)
    assert gross(lake) == want
    daily.run_day(lake, moved.limit(0), opts, day(D2))      # compaction removed the old version
    assert gross(lake) == {D1: ("10.00", "0.00")}


def test_old_version_returns_when_the_move_is_withdrawn(spark, lake):
    first = items(spark, line("a", "1", D1), line("b", "1", D1)).select(*SOURCE_ITEMS)
    moved = items(spark, line("a", "1", D2, price="12.00")).select(*SOURCE_ITEMS)
    opts = options(spark).drop("ingestion_date")
    daily.run_day(lake, first, opts, day(D1))
    daily.run_day(lake, moved, opts, day(D2))
    daily.run_day(lake, moved.limit(0), opts, day(D2))
    assert gross(lake) == {D1: ("20.00", "0.00")}


def test_views_are_published_for_sql(spark, lake, source):
    from dinerlake.plans.publish import publish_views

    daily.run_days(lake, *source, day(D1), day(D3))
    names = publish_views(lake)
    assert len(names) == 23
    got = spark.sql("select sum(gross_sales_total) from v_sales_trends_daily").first()[0]
    assert got == lake.read(MARTS[0]).agg(F.sum("gross_sales_total")).first()[0]
    for name in names:
        assert spark.table(name).columns


def test_calendar_follows_the_run(spark, lake, source):
    fair = spark.createDataFrame([(day(D2), "Fair")], "date_key date, holiday_name string")
    daily.run_days(lake, *source, day(D1), day(D2), holidays=fair)
    daily.run_days(lake, *source, day(D2), day(D3))      # adds a day, keeps the holiday
    assert rows(lake.read("silver_date_dim"), "date_key", "is_holiday") == [
        (day(D1), False), (day(D2), True), (day(D3), False)]


def test_rewrites_make_one_file_per_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    many = spark.range(2_000).selectExpr("id as x", "cast(id % 20 as string) as p").repartition(8)
    files.swap_write(many, path, "p")
    files.swap_write(files.read_table(spark, path).repartition(8), path, "p")
    assert len(list((tmp_path / "t").glob("p=*/*.parquet"))) == 20
    assert files.read_table(spark, path).count() == 2_000


def scanned_partitions(df):
    """How many partitions the file scan of ``df`` has read, by its own metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().head().metrics().apply("numPartitions").value()


def long_lake(spark, lake):
    """Sixty days of two lines each; on the last day a line of day 7 comes again."""
    start = dt.date(2024, 1, 1)
    days = [start + dt.timedelta(days=n) for n in range(60)]
    lines = [line(f"o{n}", str(i), str(d)) for n, d in enumerate(days) for i in (1, 2)]
    opts = [option(f"o{n}", "1", "x", "-1.00", ingested=str(d)) for n, d in enumerate(days)]
    lake.replace_partitions("silver_order_items", items(spark, *lines))
    lake.replace_partitions("silver_order_items_options", options(spark, *opts))
    return days


def test_a_day_run_reads_only_the_partitions_that_hold_its_lines(spark, lake):
    from dinerlake.streaming import locator

    days = long_lake(spark, lake)
    daily.build_day_marts(lake, days[0], days[-1])
    # A new version of a line of day 7 comes on day 59, with the date of day 7.
    again = items(spark, line("o7", "1", str(days[7]), price="9.00", ingested=str(days[59])), line("o59", "1", str(days[59])),
                  line("o59", "2", str(days[59])))
    lake.replace_partitions("silver_order_items", again, [days[59]])
    daily.build_day_marts(lake, days[59], days[59])
    got = tables(lake)
    daily.full_refresh(lake)
    assert tables(lake) == got

    keys, lines, opts = locator.lines_of_dates(lake, [days[7], days[59]])
    assert scanned_partitions(lines.select("order_id")) == 2
    assert scanned_partitions(opts.select("order_id")) == 2
    assert keys.count() == 4


def test_the_index_follows_silver(spark, lake):
    from dinerlake.streaming import locator

    days = long_lake(spark, lake)
    locator.refresh(lake)
    assert lake.read("silver_item_locator").count() == 120
    lake.replace_partitions("silver_order_items", items(spark, line("new", "1", str(days[3]))), [days[3]])
    lake.replace_partitions("silver_order_items", items(spark), [days[4]])
    locator.refresh(lake)
    index = lake.read("silver_item_locator")
    assert index.count() == 117 and index.filter("order_id = 'new'").count() == 1


def test_no_work_copy_is_left(spark, lake, source):
    daily.run_day(lake, *source, day(D1))
    daily.full_refresh(lake)
    folder, fs = files._folder(spark, f"{lake.root}/work")
    assert list(fs.listStatus(folder)) == []


def test_the_snapshot_comes_from_the_kept_orders(spark, lake, monkeypatch):
    """Late and moved lines over several runs: the same facts as from all lines, which are not read."""
    start = dt.date(2024, 1, 1)
    lake.replace_partitions("silver_order_items", items(spark, *[
        line(f"o{n}", i, str(start + dt.timedelta(days=n)), user=f"u{n % 3}", price=f"{n + 1}.00")
        for n in (0, 5, 20, 100, 150) for i in ("1", "2")]))
    lake.replace_partitions("silver_order_items_options", options(spark, option("o5", "1", "x", "-1.00", ingested="2024-01-06")))
    daily.build_day_marts(lake, start, start + dt.timedelta(days=200))
    # Day 160: a late order of day 50, a line of day 100 moved to day 99, one of a user unknown so far.
    when = start + dt.timedelta(days=160)
    lake.replace_partitions("silver_order_items", items(
        spark, line("late", "1", str(start + dt.timedelta(days=50)), user="u1", ingested=str(when)),
        line("o100", "1", str(start + dt.timedelta(days=99)), user="u1", price="7.00", ingested=str(when)),
        line("new", "1", str(when), user="u9")), [when])
    daily.build_day_marts(lake, when, when)
    whole = rows(daily.marts.customer_facts(daily._enrich(*daily._silver(lake)), when))
    monkeypatch.setattr(daily, "_silver", None)  # no way to the lines
    assert daily.build_snapshot(lake) == when
    assert rows(lake.read("gold_customer_facts").select(
        *daily.columns_of("gold_customer_facts"))) == whole and len(whole) == 4


def test_a_rewrite_that_fails_leaves_the_table_and_is_written_once(spark, lake, monkeypatch):
    from dinerlake.sources import versions

    lake.replace_partitions("silver_order_items", items(spark, line("a", "1", D1), line("b", "1", D2)))
    old = rows(lake.read("silver_order_items"))
    reader = lake.read("silver_order_items")
    changed = lake.read("silver_order_items").filter("order_id = 'a'")
    with monkeypatch.context() as broken:
        broken.setattr(versions, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            lake.swap("silver_order_items", changed)
    assert rows(lake.read("silver_order_items")) == old
    lake.swap("silver_order_items", changed)
    assert rows(lake.read("silver_order_items"), "order_id") == [("a",)]
    assert rows(reader) == old                  # the files that a reader has listed are still there
    home = lake.home("silver_order_items")
    assert versions._numbers(spark, home, "data") == [2]        # the failed one is gone
    lake.swap("silver_order_items", lake.read("silver_order_items").limit(0))
    assert lake.read("silver_order_items").isEmpty()
    lake.replace_partitions("silver_order_items", items(spark, line("c", "1", D3)))
    assert rows(lake.read("silver_order_items"), "order_id") == [("c",)]
    assert versions._numbers(spark, home, "data") == [2, 3]     # the newest and the one before


def test_compaction_keeps_the_files_of_partitions_without_old_versions(spark, lake):
    days = long_lake(spark, lake)
    again = items(spark, line("o7", "1", str(days[7]), price="9.00", ingested=str(days[59])),
                  line("o59", "1", str(days[59])), line("o59", "2", str(days[59])))
    lake.replace_partitions("silver_order_items", again, [days[59]])
    table, column = "silver_order_items", "ingestion_date"

    def names():
        return {str(d): files.partition_files(spark, lake.path(table), column, str(d)) for d in days}

    before, want = names(), rows(daily.current_items(lake.read(table)).select("order_id", "lineitem_id", "ingestion_date"))
    daily.compact(lake)
    after = names()
    assert [d for d in before if before[d] != after[d]] == [str(days[7])]
    assert rows(lake.read(table), "order_id", "lineitem_id", "ingestion_date") == want and len(want) == 120


def test_compaction_of_copies_within_a_day_and_without_a_key(spark, lake):
    lake.replace_partitions("silver_order_items", items(
        spark, line("a", "1", D1, price="5.00", ingested=D2), line("a", "1", D1, price="4.00", ingested=D2),
        line(None, "1", D1), line(None, "1", D1, price="3.00", ingested=D2), line("z", "1", D3)))
    lake.replace_partitions("silver_order_items_options", options(spark, option("a", "1", ingested=D1)))
    want = rows(daily.current_items(lake.read("silver_order_items")).fillna({"order_id": "-"}))
    daily.compact(lake)
    got = lake.read("silver_order_items").fillna({"order_id": "-"})
    assert rows(got) == want and len(want) == 3
    assert lake.days("silver_order_items", day(D1)) is None


def test_a_replay_run_again_adds_only_what_is_missing(lake, source, monkeypatch):
    daily.run_days(lake, *source, day(D1), day(D3), snapshot=False)
    target = dt.date(2024, 2, 1)
    bronze = ["bronze_order_items", "bronze_order_items_options"]
    with monkeypatch.context() as broken:       # ends after the lines, before their options
        broken.setattr(daily.sv, "replayed_options", None)
        with pytest.raises(TypeError):
            daily.replay_day(lake, day(D1), target, 10, target)
    daily.replay_day(lake, day(D1), target, 10, target)
    once = [rows(lake.range(t, str(target), str(target)).select("order_id", "lineitem_id")) for t in bronze]
    assert [len(found) for found in once] == [2, 1]
    daily.replay_day(lake, day(D1), target, 10, target)
    assert once == [rows(lake.range(t, str(target), str(target)).select("order_id", "lineitem_id")) for t in bronze]
