import math
import random
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dinerlake.operators.quantiles import exact_quantiles

SHARES = [0.2, 0.4, 0.6, 0.8]


def brute(values, share):
    ordered = sorted(v for v in values if v is not None)
    return ordered[max(math.ceil(Fraction(str(share)) * len(ordered)), 1) - 1]


def check(spark, values, parts=4):
    df = spark.createDataFrame([(v, v) for v in values], "a int, b int").repartition(parts)
    row = exact_quantiles(df, {"a": SHARES, "b": [0.5]}).first()
    assert [int(v) for v in row.a] == [brute(values, p) for p in SHARES]
    assert [int(v) for v in row.b] == [brute(values, 0.5)]


def test_above_the_sketch_accuracy(spark):
    rng = random.Random(3)
    check(spark, [rng.randrange(10**8) for _ in range(60_000)])


def test_one_value_holds_most_rows(spark):
    rng = random.Random(4)
    check(spark, [0] * 30_000 + [rng.randrange(1000) for _ in range(20_000)] + [None] * 5)


def test_many_ranges_for_few_values(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        rng = random.Random(5)
        check(spark, [rng.randrange(500) for _ in range(5_000)])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_groups_and_columns_without_values(spark):
    rows = [("a", 1, 2.5), ("a", 3, None), ("a", 2, None), (None, 7, 1.5), ("b", None, None)]
    df = spark.createDataFrame(rows, "g string, x int, y double")
    got = {r.g: (r.x, r.y) for r in exact_quantiles(df, {"x": [0.5, 1.0], "y": [0.5]}, by="g").collect()}
    assert got == {"a": ([2, 3], [2.5]), None: ([7, 7], [1.5]), "b": ([None, None], [None])}


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-5, 5), min_size=1, max_size=30))
def test_small_sets(spark, values):
    check(spark, values, 2)


def test_rank_is_not_hurt_by_binary_fractions(spark):
    for n in (5, 10, 15, 25):
        check(spark, list(range(n)))


def test_empty_table_gives_nulls(spark):
    row = exact_quantiles(spark.createDataFrame([], "a int"), {"a": [0.5]}).first()
    assert row.a == [None]


@pytest.mark.parametrize("parts", [1, 7])
def test_partitioning_does_not_matter(spark, parts):
    check(spark, list(range(20_011)), parts)
