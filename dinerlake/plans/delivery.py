"""A raw delivery, read once and kept by verdict.

Every raw table is scanned, typed, judged and deduplicated in one pass and written with its
``verdict`` as partition column.  The clean tables, the rejects and the loss audit are all read
from those copies, each from its own partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dinerlake.plans import silver as sv
from dinerlake.sources import files

CLEAN, REJECTED, ORPHAN = "clean", "rejected", "orphan"


@dataclass(frozen=True)
class Delivery:
    """The judged tables of one raw delivery, as written under ``root``."""

    items: DataFrame
    options: DataFrame
    dates: DataFrame

    def seed(self) -> sv.Seed:
        orphans = _verdict(self.options, ORPHAN).withColumn("reason", F.lit("missing_parent"))
        return sv.Seed(
            items=_verdict(self.items, CLEAN).drop("reason"),
            options=_verdict(self.options, CLEAN).drop("reason"),
            dates=sv.repaired_dates(_verdict(self.dates, CLEAN)),
            rejected_items=_verdict(self.items, REJECTED),
            rejected_options=_verdict(self.options, REJECTED),
            orphan_options=orphans,
            rejected_dates=_verdict(self.dates, REJECTED),
        )

    def audit(self) -> DataFrame:
        """The same figures as ``silver.loss_audit``, without the raw tables."""
        parented = F.when(F.col("verdict") == CLEAN, F.lit(True)).alias("has_parent")
        return sv.audit_of(
            self.items.select("reason", "copies"),
            self.options.select("reason", "copies", parented),
            self.dates.select("reason"))


def _verdict(judged: DataFrame, verdict: str) -> DataFrame:
    extra = [c for c in ("verdict", "copies") if c in judged.columns]
    return judged.filter(F.col("verdict") == verdict).drop(*extra)


def _stored(df: DataFrame, path: str) -> DataFrame:
    verdicts = [CLEAN, REJECTED, ORPHAN]
    # Three verdicts at most: the rows are written where they are judged.
    files.overwrite_partitions(df, path, "verdict", verdicts, gather=False)
    written = files.read_if_present(df.sparkSession, path, df.schema)
    return df.sparkSession.createDataFrame([], df.schema) if written is None else written


def deliver(
    spark: SparkSession, root: str, raw_items: DataFrame, raw_options: DataFrame, raw_dates: DataFrame
) -> Delivery:
    """Judge a delivery and write it under ``root``; a delivery that was there is replaced."""
    by_reason = F.when(F.col("reason").isNull(), CLEAN).otherwise(REJECTED)
    items = _stored(sv.counted_items(raw_items).withColumn("verdict", by_reason), f"{root}/items")
    options = sv.with_parent(sv.counted_options(raw_options), items)
    by_parent = F.when(F.col("reason").isNull() & F.col("has_parent").isNull(), ORPHAN).otherwise(by_reason)
    options = _stored(
        options.withColumn("verdict", by_parent).drop("has_parent"), f"{root}/options")
    dates = _stored(sv.judged_dates(raw_dates).withColumn("verdict", by_reason), f"{root}/dates")
    return Delivery(items, options, dates)
