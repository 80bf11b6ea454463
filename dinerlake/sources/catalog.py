"""Catalog tables and views over the parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dinerlake.schemas import PARTITION_COLUMN, TABLES


def create_table(spark: SparkSession, name: str, location: str, database: str = "default") -> str:
    """External parquet table with the declared columns and partitions.

    A table of that name over another folder is replaced; the files of both stay.
    """
    full = f"{database}.{name}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    if spark.catalog.tableExists(full) and not _lies_in(spark, full, location):
        spark.sql(f"DROP TABLE {full}")
    partition = PARTITION_COLUMN.get(name)
    clause = f"PARTITIONED BY ({partition})" if partition else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {full} ({TABLES[name]}) USING parquet "
        f"{clause} LOCATION '{location}'"
    )
    return full


def _lies_in(spark: SparkSession, full_name: str, location: str) -> bool:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {full_name}").filter("col_name = 'Location'").first()
    held = described.data_type if described else ""
    return held.rstrip("/").split(":", 1)[-1].lstrip("/") == location.rstrip("/").split(":", 1)[-1].lstrip("/")


def repair(spark: SparkSession, full_name: str) -> None:
    """Register every partition folder found on storage."""
    spark.sql(f"MSCK REPAIR TABLE {full_name}")


def add_partition(spark: SparkSession, full_name: str, column: str, value: str) -> None:
    """Register one partition without listing the others."""
    spark.sql(
        f"ALTER TABLE {full_name} ADD IF NOT EXISTS PARTITION ({column} = '{value}')"
    )


def partitions(spark: SparkSession, full_name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {full_name}")


def insert_overwrite(df: DataFrame, full_name: str) -> None:
    """Dynamic ``INSERT OVERWRITE``: only the partitions in ``df`` are replaced."""
    spark = df.sparkSession
    columns = spark.table(full_name).columns
    df.select(*columns).createOrReplaceTempView("_insert_source")
    spark.sql(
        f"INSERT OVERWRITE TABLE {full_name} SELECT {', '.join(columns)} FROM _insert_source"
    )
    spark.catalog.dropTempView("_insert_source")


def publish(views: dict[str, DataFrame]) -> None:
    """Register each DataFrame as a temporary view under its name."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
