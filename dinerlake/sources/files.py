"""CSV and parquet sources, and the partitioned table sinks."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# --- sources ----------------------------------------------------------------

def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header as text columns, taken by their header names in any order."""
    found = spark.read.option("header", True).csv(path)
    missing = [c for c in schema.fieldNames() if c not in found.columns]
    if missing:
        raise ValueError(f"{path} has no columns {missing}")
    return found.select(*[F.col(f"`{c}`") for c in schema.fieldNames()])


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_if_present(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The table, or None when nothing was written there yet."""
    try:
        return read_table(spark, path, schema)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_partitions(
    spark: SparkSession,
    path: str,
    column: str,
    first: object,
    last: object | None = None,
    schema: T.StructType | None = None,
) -> DataFrame | None:
    """Rows of one partition or of a range of them; None when missing or empty.

    The root is read and the partition column filtered, so Spark prunes the
    folders and the partition column keeps its type.
    """
    table = read_if_present(spark, path, schema)
    if table is None:
        return None
    chosen = table.filter(F.col(column).between(F.lit(first), F.lit(last or first)))
    return None if chosen.isEmpty() else chosen


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """All partitions, with the union of their columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_reconciled(
    spark: SparkSession, path: str, schema: T.StructType, column: str
) -> DataFrame:
    """All partitions under the declared ``schema``, whatever columns and types their files have.

    The partitions of ``column`` are grouped by the schema in their footers; each group is read once
    with its own schema, added columns are left out, absent ones are NULL and others are cast to the
    declared type.  ``mergeSchema`` fails where types differ.  A value that the declared type cannot
    hold is an error.  The files of one partition come from one run and are taken to be alike but for
    added columns.  Filters on ``column`` still prune each group.
    """
    groups: dict[str, list[str]] = {}
    found: dict[str, T.StructType] = {}
    # One footer per partition; there are as many as the table has days.
    for value in sorted(partition_times(spark, path, column)):
        folder = f"{path}/{column}={value}"
        own = spark.read.option("mergeSchema", "true").parquet(folder).schema
        key = own.json()
        found[key] = own
        groups.setdefault(key, []).append(folder)
    if not groups:
        return spark.createDataFrame([], schema)
    parts = []
    for key, folders in groups.items():
        stored = T.StructType([*found[key].fields, schema[column]])
        rows = spark.read.option("basePath", path).schema(stored).parquet(*folders)
        have = set(stored.fieldNames())
        parts.append(rows.select(*[
            (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields]))
    return reduce(DataFrame.unionByName, parts)


# --- sinks ------------------------------------------------------------------

def overwrite_partitions(
    df: DataFrame, path: str, column: str, values: Sequence[object] | None = None, gather: bool = True
) -> None:
    """Replace the partitions that occur in ``df``, and with ``values`` exactly those.

    A listed partition that still has its old files after the write got no rows and is
    removed.  The rebalance hint brings the rows of a partition together and lets the
    adaptive planner split a large one over several tasks and files.  Without ``gather`` each
    task writes a file per partition it meets, for few partitions.
    """
    spark, listed = df.sparkSession, [str(v) for v in values or ()]
    before = {v: partition_files(spark, path, column, v) for v in listed}
    (
        (df.hint("rebalance", F.col(column)) if gather else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(column)
        .parquet(path)
    )
    stale = [
        v for v in listed
        if before[v] and partition_files(spark, path, column, v) == before[v]
    ]
    drop_partitions(spark, path, column, stale)


def partition_files(spark: SparkSession, path: str, column: str, value: str) -> set[str]:
    """Names of the files of one partition; each write names its files anew."""
    folder, fs = _folder(spark, f"{path}/{column}={value}")
    if not fs.exists(folder):
        return set()
    return {status.getPath().getName() for status in fs.listStatus(folder)}


def partition_times(spark: SparkSession, path: str, column: str) -> dict[str, tuple[int, int]]:
    """Per partition value the times of its oldest and its newest file."""
    folder, fs = _folder(spark, path)
    found = {}
    for status in fs.listStatus(folder) if fs.exists(folder) else ():
        name = status.getPath().getName()
        if name.startswith(f"{column}="):
            times = [
                f.getModificationTime() for f in fs.listStatus(status.getPath())
                if not f.getPath().getName().startswith(("_", "."))]
            if times:
                found[name.split("=", 1)[1]] = (min(times), max(times))
    return found


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder."""
    folder, fs = _folder(spark, path)
    return fs.getContentSummary(folder).getLength()


def remove(spark: SparkSession, path: str) -> None:
    folder, fs = _folder(spark, path)
    fs.delete(folder, True)


def drop_partitions(spark: SparkSession, path: str, column: str, values: Sequence[str]) -> None:
    """Remove the folders of these partitions, where there are any."""
    for value in values:
        folder, fs = _folder(spark, f"{path}/{column}={value}")
        if fs.exists(folder):
            fs.delete(folder, True)
    if values:
        spark.catalog.refreshByPath(path)


def _folder(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def append_partitions(df: DataFrame, path: str, column: str) -> None:
    (
        df.hint("rebalance", F.col(column))
        .write.mode("append")
        .option("compression", "snappy")
        .partitionBy(column)
        .parquet(path)
    )


def write_plain(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_rejects(rejects: DataFrame, path: str, run: dt.datetime) -> bool:
    """Rejected rows as CSV under the run's time stamp; nothing if there are none."""
    if rejects.isEmpty():
        return False
    folder = f"{path}/{run:%Y%m%d-%H%M%S}"
    rejects.write.mode("overwrite").option("header", True).csv(folder)
    return True


def swap_write(df: DataFrame, path: str, partition: str | None = None) -> None:
    """Overwrite the place ``df`` may itself be read from.

    The rows are written to a new folder beside the table first, so a failure of
    ``df`` leaves the table as it was.  The table is then rewritten from that
    complete copy, partition by partition, and partitions without rows are removed.
    """
    spark = df.sparkSession
    fresh = f"{path}__new_{uuid.uuid4().hex[:8]}"
    if partition is None:
        df.write.mode("errorifexists").option("compression", "snappy").parquet(fresh)
        write_plain(spark.read.schema(df.schema).parquet(fresh), path)
    else:
        overwrite_partitions(df, fresh, partition)
        copy = read_if_present(spark, fresh, df.schema)
        before = read_if_present(spark, path, df.schema)
        # One value per partition folder, as many as the table has days.
        had = [] if before is None else [
            r[0] for r in before.select(F.col(partition).cast("string")).distinct().collect()]
        if copy is not None:
            overwrite_partitions(copy, path, partition, had)
        else:
            drop_partitions(spark, path, partition, had)
    folder, fs = _folder(spark, fresh)
    fs.delete(folder, True)
    spark.catalog.refreshByPath(path)
