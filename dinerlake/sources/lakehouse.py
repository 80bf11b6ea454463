"""Folder layout of the bronze, silver and gold tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dinerlake.operators.quality import QualityError
from dinerlake.schemas import PARTITION_COLUMN, columns_of, schema_of
from dinerlake.sources import files, versions


@dataclass(frozen=True)
class Lakehouse:
    spark: SparkSession
    root: str

    def home(self, table: str) -> str:
        layer, name = table.split("_", 1)
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def path(self, table: str) -> str:
        """The folder that holds the table now; another one after each ``swap``."""
        return versions.location(self.spark, self.home(table))

    def read(self, table: str) -> DataFrame:
        """The table with its declared schema; an error when it was never written."""
        found = self.find(table)
        if found is None:
            raise QualityError(f"{table} does not exist")
        return found

    def find(self, table: str) -> DataFrame | None:
        return files.read_if_present(self.spark, self.path(table), schema_of(table))

    def days(self, table: str, first: object, last: object | None = None) -> DataFrame | None:
        """Rows of a range of partitions, or None when there are none."""
        return files.read_partitions(
            self.spark, self.path(table), PARTITION_COLUMN[table], first, last, schema_of(table)
        )

    def replace_partitions(
        self, table: str, df: DataFrame, values: Sequence[object] | None = None
    ) -> None:
        """Dynamic overwrite: partitions that ``df`` does not touch stay, unless they are
        among ``values``; those are emptied."""
        files.overwrite_partitions(
            df.select(*columns_of(table)), self.path(table), PARTITION_COLUMN[table], values
        )

    def range(self, table: str, first: object, last: object) -> DataFrame:
        """Rows of a range of partitions; none when the table was never written."""
        column = PARTITION_COLUMN[table]
        found = self.find(table)
        if found is None:
            return self.spark.createDataFrame([], schema_of(table))
        return found.filter(F.col(column).between(F.lit(first), F.lit(last)))

    def append(self, table: str, df: DataFrame) -> None:
        files.append_partitions(
            df.select(*columns_of(table)), self.path(table), PARTITION_COLUMN[table]
        )

    def swap(self, table: str, df: DataFrame) -> None:
        """Rewrite the whole table, which ``df`` may be read from, in one step for its readers."""
        versions.rewrite(
            df.select(*columns_of(table)), self.home(table), PARTITION_COLUMN.get(table)
        )
