"""Derived tables that several registered queries read.

Silver lines, options and the marts are computed by Spark from the sample tables once per
application and written to the shared folder, as the daily run does.  The marts come straight
from the joined tables, which lie clustered by order.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dinerlake.operators.lines import enrich_lines
from dinerlake.plans import marts
from dinerlake.session import configure, keep_clusters, scan_in_parts, shared_dir, start_with_partitions
from dinerlake.sources import sample_tables as st
from dinerlake.sources.files import size_of, write_plain

# Bytes of the lines' file for each partition of a shuffle, some 200,000 lines.
PER_PARTITION = 4_000_000

_written: set[str] = set()
_dates: dict[str, tuple[dt.date, dt.date]] = {}


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")
        mark = hashlib.sha256(self.sf_dir.encode()).hexdigest()[:12]
        keep_clusters(spark)
        scan_in_parts(spark, "32m")
        start_with_partitions(spark, size_of(spark, f"{self.sf_dir}/lineitem.parquet") // PER_PARTITION)
        app = spark.sparkContext.applicationId
        self.root = f"{shared_dir(spark)}/dinerlake-work/{app}/{mark}"

    def _copy(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.root}/{name}"
        if path not in _written:
            # Every build ends in a join or sum that is dealt out, so the copies are read by all cores.
            write_plain(build(), path)
            _written.add(path)
        return self.spark.read.parquet(path)

    # silver
    def items(self) -> DataFrame:
        return self._copy("items", lambda: st.order_items(self.spark, self.sf_dir))

    def options(self) -> DataFrame:
        return self._copy("options", lambda: st.options_ingested(self.spark, self.sf_dir))

    def enriched(self) -> DataFrame:
        items = st.order_items(self.spark, self.sf_dir)
        options = st.options_ingested(self.spark, self.sf_dir)
        return enrich_lines(items, options, clustered=True)

    def lines(self) -> DataFrame:
        """The enriched lines that the marts are built from."""
        return self.enriched_copy() if f"{self.root}/enriched" in _written else self.enriched()

    def enriched_copy(self) -> DataFrame:
        """The enriched lines written once, for queries that build several marts.

        The lines of an order stay side by side, so the roll-ups collapse them before they move.
        """
        return self._copy("enriched", self.enriched)

    def date_range(self) -> tuple[dt.date, dt.date]:
        """First and last order date of the lines."""
        if self.root not in _dates:
            days = st.order_dates(self.spark, self.sf_dir)
            row = days.agg(F.min("order_date"), F.max("order_date")).first()
            _dates[self.root] = (row[0], row[1])
        return _dates[self.root]

    def snapshot(self) -> dt.date:
        return self.date_range()[1]

    def dates(self) -> DataFrame:
        return st.dates(self.spark, *self.date_range())

    def n_days(self) -> int:
        start, end = self.date_range()
        return (end - start).days + 1

    # raw text, as copies and, for queries that read it once, straight from the source
    def raw_items(self) -> DataFrame:
        return self._copy("raw_items", self.arriving_items)

    def raw_options(self) -> DataFrame:
        return self._copy("raw_options", self.arriving_options)

    def raw_dates(self) -> DataFrame:
        return self._copy("raw_dates", self.arriving_dates)

    def passing_items(self) -> DataFrame:
        """The silver lines without a copy."""
        return st.order_items(self.spark, self.sf_dir)

    def arriving_items(self) -> DataFrame:
        return st.raw_order_items(self.spark, self.sf_dir)

    def arriving_options(self) -> DataFrame:
        return st.raw_options(self.spark, self.sf_dir)

    def arriving_dates(self) -> DataFrame:
        return st.raw_dates(self.spark, self.sf_dir)

    # gold
    def g1(self) -> DataFrame:
        return self._copy("g1", lambda: marts.daily_sales_by_store(self.lines()))

    def g2(self) -> DataFrame:
        return self._copy("g2", lambda: marts.item_sales_by_day(self.lines()))

    def g3(self) -> DataFrame:
        return self._copy("g3", lambda: marts.customer_facts(self.lines(), self.snapshot()))

    def g4(self) -> DataFrame:
        return self._copy("g4", lambda: marts.discounts_by_day(self.lines()))
