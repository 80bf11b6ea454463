"""Whole-table rewrites that take effect in one step.

A rewrite goes once, complete, to a numbered folder under ``<table>__versions/data`` and counts from the
moment an empty file of that number is created under ``<table>__versions/commits``.  Creating one file is a
single step on every file system, so a reader finds the old table or the new one and nothing between; a run
that fails before it leaves the old one.  A table that was never rewritten lies in its plain folder.

The version before the newest stays, for readers that have already listed it; older ones and what failed
runs left are removed by the next commit.  A table has one writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dinerlake.sources import files

DIGITS = 12


def _numbers(spark: SparkSession, path: str, kind: str) -> list[int]:
    folder, fs = files._folder(spark, f"{path}__versions/{kind}")
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(name) for name in names if name.isdigit())


def _place(path: str, kind: str, number: int) -> str:
    return f"{path}__versions/{kind}/{number:0{DIGITS}d}"


def location(spark: SparkSession, path: str) -> str:
    """The folder that holds the table now."""
    committed = _numbers(spark, path, "commits")
    return _place(path, "data", committed[-1]) if committed else path


def rewrite(df: DataFrame, path: str, partition: str | None = None) -> str:
    """Replace the whole table, which ``df`` may be read from; returns its new folder."""
    spark = df.sparkSession
    before = _numbers(spark, path, "commits")
    number = 1 + max([0, *before, *_numbers(spark, path, "data")])
    folder = _place(path, "data", number)
    if partition is None:
        files.write_plain(df, folder)
    else:
        files.overwrite_partitions(df, folder, partition)
    commit(spark, path, number)
    _tidy(spark, path, {number, *before[-1:]})
    return folder


def commit(spark: SparkSession, path: str, number: int) -> None:
    mark, fs = files._folder(spark, _place(path, "commits", number))
    fs.create(mark, False).close()


def _tidy(spark: SparkSession, path: str, keep: set[int]) -> None:
    for kind in ("commits", "data"):
        for number in _numbers(spark, path, kind):
            if number not in keep and number < max(keep):
                files.remove(spark, _place(path, kind, number))
    if len(keep) > 1:
        files.remove(spark, path)
