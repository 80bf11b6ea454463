"""Every registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from verification.compare import compare, connect
from verification.queries import all_queries

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con() -> duckdb.DuckDBPyConnection:
    return connect(SMALL)


OWN = sorted(all_queries())


def test_every_query_has_a_twin():
    assert set(OWN) <= set(SQL)


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, con, name):
    problem, size = compare(spark, con, QUERIES[name], SQL[name], SMALL)
    assert problem == "" and size > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "gross_sales_total" in df.columns


def test_entry_works_without_the_training_data_part(tmp_path):
    """In a copy of the repository that lacks the subpackage and the pipeline."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    here = Path(entry.__file__).parent
    skip = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__")
    shutil.copytree(here, tmp_path / "repo", ignore=skip)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True,
                         text=True, check=True).stdout.split()
    assert out == [str(len(OWN)), str(len(OWN))]
