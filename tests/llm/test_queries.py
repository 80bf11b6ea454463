"""Queries that SQL can express, against DuckDB."""

import pytest

from dinerlake.llm.oracles import SQL
from dinerlake.llm.queries import QUERIES
from tests.conftest import SMALL
from verification.compare import compare, connect


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    problem, size = compare(spark, connect(SMALL), QUERIES[name], SQL[name], SMALL)
    assert problem == "" and size > 0


@pytest.mark.parametrize("name", ["op6_licenses", "op9_main_text"])
def test_query_covers_its_table(spark, name):
    source = {"op6_licenses": "documents", "op9_main_text": "pages"}[name]
    got = QUERIES[name](spark, SMALL)
    assert got.count() == spark.read.parquet(f"{SMALL}/{source}.parquet").count()
