import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dinerlake.functions import cleansing as cl


def apply(spark, fn, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("t"))).collect()]


@pytest.mark.parametrize("text,expected", [
    ("(7.00)", "-7.00"),
    ("−$1,234.50", "-1234.50"),
    ("–5", "-5.00"),
    (" $3.5 ", "3.50"),
    ("905.10", "905.10"),
    ("", None), ("-", None), (".", None), ("-.", None), ("   ", None),
    ("12abc", None), (None, None), ("1e5", None), ("(-7)", None),
    ("999999999999.00", None),
])
def test_parse_money(spark, text, expected):
    got = apply(spark, cl.parse_money, text)[0]
    assert got == (None if expected is None else Decimal(expected))


def test_mask_card_plain_and_dashed(spark):
    assert apply(
        spark, cl.mask_card, "4111111111111111", "4111-1111-1111-1111", "1234", None
    ) == ["XXXXXXXXXXXX1111", "XXXX-XXXX-XXXX-1111", "1234", None]


def test_parse_bool(spark):
    assert apply(
        spark, cl.parse_bool, "yes", "T", "0", "maybe", "TRUE", "n", "1", None, ""
    ) == [True, True, False, None, True, False, True, None, None]


def test_parse_date_order_of_patterns(spark):
    texts = ["1/2/23", "01-02-2023", "1/2/2023", "01-13-2023", "bad", "31-01-2023", None]
    assert apply(spark, cl.parse_date, *texts) == [
        dt.date(2023, 1, 2), dt.date(2023, 2, 1), dt.date(2023, 1, 2), dt.date(2023, 1, 13),
        None, dt.date(2023, 1, 31), None,
    ]


def test_strip_urls_and_cap(spark):
    assert apply(spark, cl.strip_urls, "Tea https://x.y/z", "http://a b", None) == [
        "Tea", "b", None]
    assert apply(spark, lambda c: cl.cap(c, 3), "abcdef", "ab", None) == ["abc", "ab", None]


def test_bad_text_is_null_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert apply(spark, cl.parse_timestamp, "2024-01-02 03:04:05", "nope") == [
        dt.datetime(2024, 1, 2, 3, 4, 5), None]
    assert apply(spark, cl.parse_int, "7", "seven") == [7, None]


def test_fingerprint_keeps_null_positions_apart(spark):
    df = spark.createDataFrame(
        [("a", None, "b"), ("a", "b", None)], "x string, y string, z string"
    )
    marks = [r[0] for r in df.select(cl.fingerprint("x", "y", "z")).collect()]
    assert marks[0] != marks[1] and all(len(m) == 64 for m in marks)
