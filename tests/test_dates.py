import datetime as dt

from pyspark.sql import functions as F

from dinerlake.functions import dates as d
from dinerlake.operators.calendar import calendar, date_dim, join_dates, upsert_dates
from tests.helpers import day


def day_frame(spark, *texts):
    return spark.createDataFrame([(day(t),) for t in texts], "order_date date")


def kept(df):
    return sorted(str(r[0]) for r in df.select("order_date").collect())


def test_last_days_is_inclusive(spark):
    end = dt.date(2024, 6, 30)
    for width in (30, 90, 91):
        back = [end - dt.timedelta(days=n) for n in (0, width - 1, width)]
        df = spark.createDataFrame([(x,) for x in back], "order_date date")
        assert kept(df.filter(d.last_days(df, width))) == sorted(str(x) for x in back[:2])


def test_last_12_months_clamps_month_end(spark):
    df = day_frame(spark, "2024-01-31", "2023-02-28", "2023-02-27")
    assert kept(df.filter(d.last_12_months(df))) == ["2023-02-28", "2024-01-31"]
    leap = day_frame(spark, "2025-01-31", "2024-02-29", "2024-02-28")
    assert kept(leap.filter(d.last_12_months(leap))) == ["2024-02-29", "2025-01-31"]


def test_windows_anchor_on_the_data(spark):
    df = day_frame(spark, "2001-01-01", "2001-01-02")
    assert kept(df.filter(d.last_days(df, 1))) == ["2001-01-02"]


def test_shift_days_keeps_time_and_type(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 2, 28, 23, 59, 1),)], "t timestamp")
    moved = df.select(d.shift_days("t", 2).alias("t"))
    assert moved.first()[0] == dt.datetime(2024, 3, 1, 23, 59, 1)
    assert moved.schema["t"].dataType.typeName() == "timestamp"


def test_calendar_attributes(spark):
    rows = {str(r.date_key): r for r in calendar(
        spark, dt.date(2022, 12, 31), dt.date(2023, 1, 2)).collect()}
    assert len(rows) == 3
    sunday = rows["2023-01-01"]
    assert (sunday.week, sunday.day_of_week, sunday.is_weekend) == (52, "Sunday", True)
    monday = rows["2023-01-02"]
    assert (monday.week, monday.day_of_week, monday.is_weekend) == (1, "Monday", False)


def test_calendar_agrees_with_python_over_years(spark):
    start, end = dt.date(1999, 12, 25), dt.date(2005, 1, 5)
    rows = calendar(spark, start, end).collect()
    assert len(rows) == (end - start).days + 1
    for r in rows:
        iso = r.date_key.isocalendar()
        assert (r.week, r.is_weekend) == (iso.week, r.date_key.weekday() >= 5)
        assert r.day_of_week == r.date_key.strftime("%A")


def test_empty_range_has_no_rows(spark):
    assert calendar(spark, dt.date(2024, 1, 2), dt.date(2024, 1, 1)).count() == 0


def test_date_dim_holidays(spark):
    holidays = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "B"), (dt.date(2024, 1, 1), "A")],
        "date_key date, holiday_name string",
    )
    dim = date_dim(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 2), holidays)
    rows = {str(r.date_key): (r.is_holiday, r.holiday_name) for r in dim.collect()}
    assert rows == {"2024-01-01": (True, "A"), "2024-01-02": (False, None)}


def test_upsert_replaces_only_given_days(spark):
    none = spark.createDataFrame([], "date_key date, holiday_name string")
    some = spark.createDataFrame([(dt.date(2024, 1, 2), "X")], none.schema)
    old = date_dim(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 3), none)
    new = date_dim(spark, dt.date(2024, 1, 2), dt.date(2024, 1, 2), some)
    merged = upsert_dates(old, new)
    assert merged.count() == 3
    assert [str(r.date_key) for r in merged.filter("is_holiday").collect()] == ["2024-01-02"]


def test_calendar_is_broadcast_only_when_small(spark):
    none = spark.createDataFrame([], "date_key date, holiday_name string")
    dim = date_dim(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 3), none)
    facts = day_frame(spark, "2024-01-01")
    hinted = join_dates(facts, dim, 3)._jdf.queryExecution().optimizedPlan().toString()
    free = join_dates(facts, dim)._jdf.queryExecution().optimizedPlan().toString()
    huge = join_dates(facts, dim, 10**7)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in hinted and "broadcast" not in free and "broadcast" not in huge


def test_weekday_number_sorts_monday_first(spark):
    df = spark.createDataFrame([("Sunday",), ("Monday",), ("Friday",)], "n string")
    got = [r[0] for r in df.orderBy(d.weekday_number(F.col("n"))).collect()]
    assert got == ["Monday", "Friday", "Sunday"]
