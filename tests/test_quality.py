import datetime as dt

import pytest
from pyspark.sql import functions as F

from dinerlake.operators import quality as ql
from dinerlake.plans import delivery
from dinerlake.plans import silver as sv
from dinerlake.schemas import RAW_DATES, RAW_ITEMS, RAW_OPTIONS
from dinerlake.sources import files
from tests.helpers import rows


def raw_item(order="o1", item="1", when="2024-01-01 10:00:00", price="5.00",
             category="Tea", name="Green", card="4111-1111-1111-1111", qty="2", loyal="yes"):
    return ("app", "7", when, order, "u", card, loyal, "USD", item, category, name, price, qty)


@pytest.fixture(scope="module")
def raw_items(spark):
    data = [
        raw_item(),
        raw_item(),                                           # copy
        raw_item(item="2", category=None, name=None),         # NULL text is legal
        raw_item(item="3", when="nope", price="bad"),         # first reason wins
        raw_item(order=None, item="4"),
        raw_item(item="5", category="c" * 65),
        raw_item(item="6", category="c" * 64, name="n" * 128),
        raw_item(item="7", name="n" * 129),
        raw_item(item="8", price="12abc"),
        raw_item(item="9", category="Tea https://x.y/z", price="(7.00)"),
    ]
    return spark.createDataFrame(data, RAW_ITEMS)


@pytest.fixture(scope="module")
def raw_options(spark):
    data = [
        ("o1", "1", "g" * 70, "n" * 130, "1.00", "1"),
        ("o1", "1", "g", None, "1.00", "1"),
        ("o1", "1", "g", "milk", "oops", "1"),
        ("o1", "1", "g", "milk", "(2.00)", "1"),
        ("o1", "1", "g", "milk", "(2.00)", "1"),
        ("o1", "5", "g", "milk", "1.00", "1"),    # parent was rejected
        ("o9", "1", "g", "milk", "1.00", "1"),    # no parent at all
    ]
    return spark.createDataFrame(data, RAW_OPTIONS)


@pytest.fixture(scope="module")
def raw_dates(spark):
    data = [
        (" 1/2/23 ", "2023", "1", "1", None, "FALSE", "TRUE", "Day after"),
        ("01-02-2023", "x", None, "n/a", None, "F", "N", None),
        ("bad", None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(data, RAW_DATES)


def test_reject_reasons(raw_items):
    counts = dict(rows(ql.rejects_by_reason(sv.judged_items(raw_items))))
    assert counts == {
        "NULL_creation_time": 1, "NULL_key": 1, "item_category_too_long": 1,
        "item_name_too_long": 1, "bad_price": 1,
    }


def raw_options_of(df):
    from dinerlake.schemas import RAW_OPTIONS

    return df.sparkSession.createDataFrame([], RAW_OPTIONS)


def raw_dates_of(df):
    from dinerlake.schemas import RAW_DATES

    return df.sparkSession.createDataFrame([], RAW_DATES)


def test_no_row_is_lost(raw_items):
    judged = sv.judged_items(raw_items)
    assert ql.accepted(judged).count() + ql.rejected(judged).count() == judged.count() == 9
    more = raw_items.unionByName(raw_items.filter("ORDER_ID is null"))
    keyless = sv.judged_items(more).filter("order_id is null or lineitem_id is null").count()
    assert keyless == more.filter("ORDER_ID is null or LINEITEM_ID is null").count() == 2
    audit = dict(rows(sv.loss_audit(more, raw_options_of(more), raw_dates_of(more))))
    assert audit["items_clean"] + audit["items_rejected"] + audit["items_dupes_removed"] == more.count()


def test_null_category_is_kept(raw_items):
    clean = {r.lineitem_id: r for r in sv.clean_items(raw_items).collect()}
    assert sorted(clean) == ["1", "2", "6", "9"]
    assert clean["2"].item_category is None
    assert (clean["9"].item_category, str(clean["9"].item_price)) == ("Tea", "-7.00")
    assert clean["1"].printed_card_number == "XXXX-XXXX-XXXX-1111"


def test_option_rules_and_parents(raw_items, raw_options, raw_dates):
    seed = sv.seed(raw_items, raw_options, raw_dates)
    kept = rows(seed.options, "order_id", "lineitem_id", F.length("option_name"),
                F.length("option_group_name"))
    assert kept == [("o1", "1", 4, 1), ("o1", "1", 128, 64)]
    orphans = rows(seed.orphan_options, "order_id", "lineitem_id", "reason")
    assert orphans == [("o1", "5", "missing_parent"), ("o9", "1", "missing_parent")]
    assert seed.rejected_items.count() == 5 and seed.rejected_dates.count() == 1


def test_dates_are_repaired(raw_dates):
    got = {str(r.date_key): r for r in sv.clean_dates(raw_dates).collect()}
    first = got["2023-01-02"]
    assert (first.month, first.week, first.year, first.day_of_week) == (
        "January", 1, 2023, "Monday")
    assert first.is_holiday and first.holiday_name == "Day after"
    second = got["2023-02-01"]
    assert (second.month, second.week, second.year, second.is_weekend) == (
        "February", 5, 2023, False)


def test_loss_audit(raw_items, raw_options, raw_dates):
    audit = dict(rows(sv.loss_audit(raw_items, raw_options, raw_dates)))
    assert audit["items_raw"] == 10 and audit["items_dupes_removed"] == 1
    assert audit["items_clean"] + audit["items_rejected"] + audit["items_dupes_removed"] == 10
    assert audit["opts_parented"] + audit["opts_orphans"] == audit["opts_clean"] == 4
    assert (audit["date_dim_good"], audit["date_dim_bad"]) == (2, 1)
    assert audit["opts_raw"] == raw_options.count() == (
        audit["opts_clean"] + audit["opts_rejected"] + audit["opts_dupes_removed"])
    assert audit["opts_rejected"] == sv.rejected_options(raw_options).count()
    bad = sv.seed(raw_items, raw_options, raw_dates).rejected_dates.first()
    assert bad.date_key is None and bad.date_key_str
    assert audit["items_rejected_bad_price"] == 1


def test_assertions(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    ql.assert_has_columns(df, ["a", "b"])
    ql.assert_nonempty(df)
    ql.assert_no_nulls(df, ["a"])
    ql.assert_partition_present(df, "a", 2)
    ql.assert_latest(df, "a", 2)
    for check in (
        lambda: ql.assert_has_columns(df, ["c"]),
        lambda: ql.assert_nonempty(df.filter("a > 5")),
        lambda: ql.assert_no_nulls(df, ["a", "b"]),
        lambda: ql.assert_partition_present(df, "a", 9),
        lambda: ql.assert_latest(df, "a", 1),
    ):
        with pytest.raises(ql.QualityError):
            check()


def test_reject_sink_writes_only_rejects(spark, raw_items, tmp_path):
    run = dt.datetime(2024, 1, 2, 3, 4, 5)
    rejects = ql.rejected(sv.judged_items(raw_items))
    assert files.write_rejects(rejects, str(tmp_path / "r"), run)
    back = spark.read.option("header", True).csv(str(tmp_path / "r" / "20240102-030405"))
    assert back.count() == 5 and "reason" in back.columns
    assert not files.write_rejects(rejects.filter("false"), str(tmp_path / "none"), run)
    assert not (tmp_path / "none").exists()


def test_csv_source_reads_text(spark, tmp_path):
    path = tmp_path / "items.csv"
    names = ",".join(RAW_ITEMS.fieldNames())
    path.write_text(names + "\r\napp,7,2024-01-01 10:00:00,o,u,4111,T,USD,1,c,n,$5.00,2\r\n")
    df = files.read_csv(spark, str(path), RAW_ITEMS)
    assert {f.dataType.typeName() for f in df.schema} == {"string"}
    assert str(sv.clean_items(df).first().item_price) == "5.00"


def test_copies_are_counted_and_keyless_rows_stay(spark):
    df = spark.createDataFrame(
        [("a", "1", None), ("a", "1", "x"), ("a", "1", "b"), ("a", None, "z"), ("a", None, "z")],
        "order_id string, lineitem_id string, item_name string")
    got = sv.counted_per_key(df, ["order_id", "lineitem_id"], F.col("lineitem_id").isNull())
    line = F.coalesce("lineitem_id", F.lit("-"))
    assert rows(got, line, "item_name", "copies") == [("-", "z", 1), ("-", "z", 1), ("1", "b", 3)]
    assert got.columns == [*df.columns, "copies"]


def test_each_raw_table_is_scanned_once(spark, work):
    for raw, build in ((work.raw_items(), sv.counted_items), (work.raw_options(), sv.counted_options)):
        plan = build(raw)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Window" not in plan


def test_delivery_keeps_every_row_by_verdict(spark, tmp_path, raw_items, raw_options, raw_dates):
    seed = sv.seed(raw_items, raw_options, raw_dates)
    for _ in range(2):
        kept = delivery.deliver(spark, str(tmp_path / "d"), raw_items, raw_options, raw_dates)
    for name in ("items", "options", "dates", "rejected_items", "rejected_options",
                 "orphan_options", "rejected_dates"):
        left, right = getattr(kept.seed(), name), getattr(seed, name)
        assert left.columns == right.columns and left.exceptAll(right).isEmpty()
        assert right.exceptAll(left).isEmpty()
    assert dict(rows(kept.audit())) == dict(rows(sv.loss_audit(raw_items, raw_options, raw_dates)))
    clean = kept.seed().items._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in clean and "FileScan" in clean and "Exchange" not in clean


def test_delivery_without_rows_replaces_the_last(spark, tmp_path, raw_items, raw_options, raw_dates):
    root = str(tmp_path / "d")
    delivery.deliver(spark, root, raw_items, raw_options, raw_dates)
    nothing = [df.limit(0) for df in (raw_items, raw_options, raw_dates)]
    kept = delivery.deliver(spark, root, *nothing)
    assert kept.seed().items.isEmpty() and kept.seed().rejected_options.isEmpty()
    assert set(dict(rows(kept.audit())).values()) == {0}
