"""Exact quantiles of a large table by ranges.

The distinct values are counted, sorted into ranges once, and the counts of the ranges are summed
up.  That tells in which range a rank lies, and only those ranges are looked at value by value.  No
sketch, no task that sees a whole group: a group of any size is spread over its ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dinerlake.session import cut_lineage

GROUP, OF, PART = "target_group", "target_of", "target_part"


def rank_of(share: float, rows: Column) -> Column:
    """The least rank with at least ``share`` of ``rows`` at or below it; decimal, as shares are written."""
    exact = F.ceil(F.lit(Decimal(str(share))) * rows).cast("bigint")
    return F.greatest(exact, F.lit(1).cast("bigint"))


def ranged_counts(df: DataFrame, group: Column, columns: Sequence[str]) -> DataFrame:
    """Distinct (group, column, value) with their count, sorted by range; one value field per column.

    NULLs count nothing but keep their group.
    """
    def entry(number: int) -> Column:
        fields = [
            (F.col(c) if n == number else F.lit(None).cast(df.schema[c].dataType)).alias(f"_v_{n}")
            for n, c in enumerate(columns)
        ]
        return F.struct(F.lit(number).alias(OF), *fields, F.col(columns[number]).isNotNull().alias("_held"))

    values = [f"_v_{n}" for n in range(len(columns))]
    counted = (
        df.select(group.alias(GROUP), F.inline(F.array(*[entry(n) for n in range(len(columns))])))
        .groupBy(GROUP, OF, *values).agg(F.count_if("_held").alias("_n"))
    )
    # The numbers of the ranges are used twice, so they have to be fixed.
    return cut_lineage(
        counted.repartitionByRange(GROUP, OF, *values).withColumn(PART, F.spark_partition_id()))


def exact_quantiles(
    df: DataFrame, wanted: Mapping[str, Sequence[float]], by: str | None = None
) -> DataFrame:
    """One row, or one per value of ``by``, with an array of quantiles per column of ``wanted``.

    The quantile of share p is the smallest value with at least p of the non-NULL
    rows at or below it, in the column's own type.  A column without values gives
    NULLs, and so does an empty table without ``by``.
    """
    columns = list(wanted)
    values = [f"_v_{n}" for n in range(len(columns))]
    ranged = ranged_counts(df, F.lit(0) if by is None else F.col(by), columns)

    # One row per range, and one more where a range holds the end of one group and the next.
    parts = ranged.groupBy(GROUP, OF, PART).agg(F.sum("_n").alias("_sum"))
    up = Window.partitionBy(GROUP, OF).orderBy(PART)
    upto = F.sum("_sum").over(up.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = parts.withColumns({"_upto": upto, "_rows": F.sum("_sum").over(Window.partitionBy(GROUP, OF))})
    ranks = F.coalesce(*[
        F.when(F.col(OF) == n, F.array(*[
            F.struct(F.lit(i).alias("_i"), rank_of(p, F.col("_rows")).alias("_rank"))
            for i, p in enumerate(wanted[c])
        ])) for n, c in enumerate(columns)
    ])
    targets = (
        placed.select(GROUP, OF, PART, "_upto", "_sum", F.inline(ranks))
        .where((F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > F.col("_upto") - F.col("_sum")))
        .select(F.col(GROUP).alias("_g"), F.col(OF).alias("_o"), F.col(PART).alias("_p"), "_i",
                (F.col("_rank") - (F.col("_upto") - F.col("_sum"))).alias("_rank"))
    )
    met = ranged.join(
        targets, F.col(GROUP).eqNullSafe(F.col("_g")) & (F.col(OF) == F.col("_o")) & (F.col(PART) == F.col("_p")))
    inside = Window.partitionBy(GROUP, OF, PART, "_i").orderBy(*values)
    reached = F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    hits = met.withColumn("_reached", reached).where(
        (F.col("_reached") >= F.col("_rank")) & (F.col("_reached") - F.col("_n") < F.col("_rank")))

    # Groups without a value have no hit but still a row.
    blank = parts.select(GROUP).distinct().select(
        GROUP, F.lit(-1).alias(OF), F.lit(-1).alias("_i"),
        *[F.lit(None).cast(df.schema[c].dataType).alias(v) for c, v in zip(columns, values)])
    every = hits.select(GROUP, OF, "_i", *values).unionByName(blank)
    arrays = [
        F.array(*[
            F.max(F.when((F.col(OF) == n) & (F.col("_i") == i), F.col(values[n])))
            for i in range(len(wanted[c]))
        ]).alias(c) for n, c in enumerate(columns)
    ]
    if by is None:
        return every.agg(*arrays)
    return every.groupBy(GROUP).agg(*arrays).withColumnRenamed(GROUP, by)
