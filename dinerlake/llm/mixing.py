"""Mixing sources to target weights.

Every document gets a hash-random key.  Within its source the documents are sorted by that key in
ranges of the key, word counts are summed over the ranges before a document, and the source is cut
where the running total meets its budget; a budget beyond one pass repeats whole passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dinerlake.llm.common import WORD, written

RANGE_DIGITS = 3  # leading hex digits of the key that name a range: 4,096 ranges per source


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix_key(seed: str) -> Column:
    """Hash of id and text, so that copies and NULL ids spread as well."""
    return F.md5(F.concat_ws(
        "|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")),
    ).cast("binary"))


def numbered_sources(sources: DataFrame) -> DataFrame:
    """``sources`` with ``place``: its position by code point from 0, NULL last.

    Range-sorted in parallel; the offsets come from one count per range.
    """
    ranged = written(
        sources.repartitionByRange(F.col("source").asc_nulls_last())
        .withColumn("part", F.spark_partition_id()),
        "sources",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return (
        ranged.join(offsets, "part")
        .withColumn("place", F.col("offset") + F.row_number().over(within) - 1)
        .drop("part", "offset")
    )


def source_targets(sources: DataFrame, weights: tuple[int, ...], share: float,
                   passes: int) -> DataFrame:
    """``target`` per source: ``share`` of all words dealt by weight, no source above
    ``passes`` times its size; what a full source leaves goes to the others by weight.

    The level (words per unit of weight) only rises from round to round, and every round fills
    at least one more source; each round is one aggregate row.
    """
    place = F.col("place") % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int"))
    base = written(
        numbered_sources(sources)
        .withColumn("weight", weight.cast("long"))
        .withColumn("full", F.col("source_size") * passes),
        "targets",
    )
    total, weight_sum = base.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted = share * (total or 0)
    level = wanted / weight_sum if weight_sum else 0.0
    while True:
        is_full = F.col("full") <= F.lit(level) * F.col("weight")
        filled, open_weight = base.agg(
            F.coalesce(F.sum(F.when(is_full, F.col("full"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~is_full, F.col("weight"))), F.lit(0)),
        ).first()
        new_level = (wanted - filled) / open_weight if open_weight else float("inf")
        if new_level <= level or open_weight == 0:
            break
        level = new_level
    target = F.least(F.col("full").cast("double"), F.lit(level) * F.col("weight"))
    return base.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
        passes: int = 2, seed: str = "mix", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    ``taken`` counts the words that the mix takes, repeats included; the document at the cut is
    taken in part, so a source gets exactly ``floor(target)`` words.  A NULL text has size 0 and
    is never taken.  A NULL source is a source of its own, the last.  Repeated rows share a key and
    are ordered by id and size, so the result as a set of rows does not depend on the run.  An empty
    table gives no rows.  Of the other columns, those named in ``keep`` come along.
    """
    rows = written(
        docs.select(*keep, "doc_id", "source", n_words().alias("size"), mix_key(seed).alias("key"))
        .withColumn("range", F.substring("key", 1, RANGE_DIGITS)),
        "mix",
    )
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources, weights, share, passes)

    earlier = (
        Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    )
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("words")).select(
        "source", "range",
        F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before_range"),
    )
    inside = (
        Window.partitionBy("source", "range").orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    cut = (
        placed.alias("d")
        .join(ranges.alias("r"), F.col("d.source").eqNullSafe(F.col("r.source"))
              & (F.col("d.range") == F.col("r.range")))
        .join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
        .select(
            *keep, "doc_id", "d.source", "size", "source_size", "target",
            (F.col("before_range") + F.col("inside")).alias("before"),
            F.floor("target").cast("long").alias("budget"),
        )
    )
    size, whole = F.col("source_size"), F.col("whole")
    rest = F.col("budget") - whole * size - F.col("before")
    return (
        cut.withColumn("whole", F.when(size > 0, F.expr("budget div source_size")).otherwise(0))
        .withColumn("taken", whole * F.col("size") + F.greatest(
            F.lit(0).cast("long"), F.least(F.col("size"), rest)))
        .select(*keep, "doc_id", "source", "size", "source_size", "target", "taken")
    )
