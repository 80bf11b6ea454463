import datetime as dt

import pytest
from pyspark.sql import types as T

from dinerlake.schemas import TABLES, schema_of
from dinerlake.sources import catalog, files, jdbc
from tests.helpers import day, mart, rows

DB = jdbc.JdbcDatabase("jdbc:sqlserver://host", "reader", "secret")
START, END = dt.date(2024, 1, 30), dt.date(2024, 1, 31)


def test_single_read_options():
    got = jdbc.read_options(DB, "SELECT 1 AS x")
    assert got["query"] == "SELECT 1 AS x" and got["fetchsize"] == "10000"
    assert "dbtable" not in got and got["driver"].endswith("SQLServerDriver")


def test_partitioned_read_options():
    got = jdbc.read_options(DB, "SELECT 1 AS x", jdbc.day_ranges(START, END, 8))
    assert got["dbtable"] == "(SELECT 1 AS x) k" and "query" not in got
    assert got["partitionColumn"] == "creation_time_utc" and got["numPartitions"] == "8"
    assert (got["lowerBound"], got["upperBound"]) == ("2024-01-30 00:00:00", "2024-02-01 00:00:00")


def test_write_options():
    got = jdbc.write_options(DB, "dbo.order_items")
    assert got["dbtable"] == "dbo.order_items" and got["batchsize"] == "2000"


def test_day_queries_use_a_half_open_range():
    sql = jdbc.items_query(START, END)
    assert "creation_time_utc >= '2024-01-30' AND creation_time_utc < '2024-02-01'" in sql
    assert "CAST(" not in sql and sql.count(",") == len(jdbc.ITEM_COLUMNS) - 1
    child = jdbc.options_query(START, START)
    assert "EXISTS" in child and "< '2024-01-31'" in child
    assert jdbc.parent_keys_query() == "SELECT order_id, lineitem_id FROM dbo.order_items"


def test_password_is_not_shown():
    assert "secret" not in repr(DB)


def test_all_schemas_parse():
    for table in TABLES:
        assert schema_of(table).fieldNames()


def test_catalog_table_and_partitions(spark, tmp_path):
    name, where = "gold_daily_sales_by_store", tmp_path / "g1"
    full = catalog.create_table(spark, name, str(where))

    def part(d, gross):
        return mart(spark, name, dict(restaurant_id="1", order_date=day(d), orders_count=gross))

    catalog.insert_overwrite(part("2024-01-01", 1).unionByName(part("2024-01-02", 2)), full)
    catalog.insert_overwrite(part("2024-01-02", 9), full)
    assert rows(spark.table(full), "order_date", "orders_count") == [
        (day("2024-01-01"), 1), (day("2024-01-02"), 9)]
    for d in ("2024-01-03", "2024-01-04"):
        part(d, 5).drop("order_date").write.parquet(str(where / f"order_date={d}"))
    catalog.add_partition(spark, full, "order_date", "2024-01-03")
    assert catalog.partitions(spark, full).count() == 3
    catalog.repair(spark, full)
    assert catalog.partitions(spark, full).count() == 4
    assert spark.table(full).count() == 4
    spark.sql(f"DROP TABLE {full}")


def test_published_views(spark):
    catalog.publish({"v_ten": spark.range(10).toDF("x")})
    assert spark.sql("select count(*) from v_ten").first()[0] == 10


def test_partitions_with_other_types_are_read_under_the_declared_schema(spark, tmp_path):
    path, declared = str(tmp_path / "t"), T.StructType.fromDDL("a decimal(10,2), b string, d date")
    assert files.read_reconciled(spark, path, declared, "d").isEmpty()
    for body in ("1 as a, 'x' as b, date'2024-01-01' as d",
                 "cast(2.5 as decimal(10,2)) as a, date'2024-01-02' as d",
                 "cast(3 as bigint) as a, 7 as b, true as extra, date'2024-01-03' as d",
                 "4 as a, 'y' as b, date'2024-01-04' as d"):
        files.overwrite_partitions(spark.sql(f"select {body}"), path, "d")
    got = files.read_reconciled(spark, path, declared, "d")
    assert got.schema.simpleString() == declared.simpleString()
    assert [(str(r.a), r.b, str(r.d)) for r in got.orderBy("d").collect()] == [
        ("1.00", "x", "2024-01-01"), ("2.50", None, "2024-01-02"), ("3.00", "7", "2024-01-03"),
        ("4.00", "y", "2024-01-04")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3          # one for each schema, not for each day
    with pytest.raises(Exception):
        files.read_merged(spark, path).collect()
