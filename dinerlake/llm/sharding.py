"""Shards of near equal bytes by k-d tree partitioning.

A node of the tree holds some documents and a number of shards.  It is split along the dimension of the
metadata in which its documents lie widest apart, at the weighted median of their bytes (with an odd number
of shards at the matching quantile), until every leaf is one shard.  All nodes of a level are split
together: the narrow rows are sorted by range of (node, dimension), the bytes of the ranges are summed and the
cut is taken where the running total meets the share.  Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dinerlake.llm.common import configure, scratch, written

HOT_SHARE = 1_000  # a group of copies with more than this fraction of the rows is looked up apart
PREFIX_BYTES = 6  # of a string, that give its place among others when widths are compared
PIECES = 64  # a group of copies up to this part of a shard is not cut
DIMENSIONS = ("source", "lang", "size", "id")


def place(value: Column) -> Column:
    """The first bytes of a string as a number that keeps their order."""
    head = F.substring(F.hex(F.coalesce(value, F.lit("")).cast("binary")), 1, 2 * PREFIX_BYTES)
    return F.conv(F.rpad(head, 2 * PREFIX_BYTES, "0"), 16, 10).cast("long")


def narrow(docs: DataFrame, overhead: int) -> DataFrame:
    """What is needed of every document: id, size, checksum, digest of the text and metadata.

    Missing metadata are empty; copies of one text share those of their least id, so that they
    lie in one place of the tree.
    """
    for name in ("source", "lang"):
        if name not in docs.columns:
            docs = docs.withColumn(name, F.lit(None).cast("string"))
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = written(docs.select(
        "doc_id", F.octet_length(raw).cast("long").alias("bytes"), F.crc32(raw).alias("text_crc32"),
        F.when(F.col("text").isNull(), "").otherwise(F.md5(raw)).alias("digest"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        F.xxhash64("doc_id", "source", "lang").alias("salt"),
    ).withColumn("size", F.col("bytes") + overhead).withColumn("rid", F.monotonically_increasing_id()), "rows")

    own = F.struct(F.col("doc_id").isNull(), "doc_id", "source", "lang")
    groups = written(
        rows.groupBy("digest").agg(F.count("*").alias("copies"), F.min(own).alias("first"))
        .where("copies > 1"), "copies")
    total = rows.count()
    # At most HOT_SHARE groups can each hold more than one HOT_SHARE-th of the rows.
    is_hot = F.col("copies") * HOT_SHARE > total
    hot = F.broadcast(groups.where(is_hot).select("digest", F.col("first").alias("hot")))
    cold = groups.where(~is_hot).select("digest", F.col("first").alias("cold"))
    met = rows.join(hot, "digest", "left")
    # Rows that are served, or need not be, go anywhere: their own key has no partner.
    seek = F.when(F.col("hot").isNull(), F.col("digest")).otherwise(F.concat(F.lit("#"), F.col("rid").cast("string")))
    met = met.withColumn("seek", seek).join(cold.withColumnRenamed("digest", "seek"), "seek", "left")
    first = F.coalesce("hot", "cold", own)
    return met.select(
        "rid", "doc_id", "size", "text_crc32", "digest", first["source"].alias("source"),
        first["lang"].alias("lang"), F.coalesce(first["doc_id"].try_cast("long"), F.lit(0)).alias("id"))


def running(rows: DataFrame, group: str, order: list[str], weight: Column, tag: str) -> DataFrame:
    """``rows`` with ``before``: the weight of the rows before each one of its group.

    Rows are sorted by range; a range holds a part of a group, however large that is, and its
    offset comes from one total per range.
    """
    ranged = written(
        rows.withColumn("weight", weight).repartitionByRange(group, *order)
        .withColumn("part", F.spark_partition_id()), tag)
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(group, "part").agg(F.sum("weight").alias("sum")).select(
        group, "part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(group, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumn("inside", F.coalesce(F.sum("weight").over(inside), F.lit(0)))
        .join(F.broadcast(offsets), [group, "part"])  # one row per range, and per group and range at its edge
        .withColumn("before", F.col("offset") + F.col("inside"))
        .drop("part", "inside", "offset", "weight")
    )


def widths(rows: DataFrame) -> list[Column]:
    spans = {"source": place(F.col("source")), "lang": place(F.col("lang")), "size": F.col("size"), "id": F.col("id")}
    return [(F.max(c) - F.min(c)).cast("double").alias(f"w_{d}") for d, c in spans.items()]


def split(rows: DataFrame, nodes: list[tuple[int, int]], whole: list[float], level: int, target: float) -> DataFrame:
    """One level: every node ``(first shard, shards)`` of two shards or more is cut in two.

    ``nodes`` are the nodes of the level, at most as many as there are shards.
    """
    spark = rows.sparkSession
    cut = [(first, first + n // 2, n // 2 / n) for first, n in nodes if n > 1]
    plan = F.broadcast(spark.createDataFrame(cut, "node int, right int, share double"))
    ratio = [F.when(F.lit(w) > 0, F.col(f"w_{d}") / F.lit(w or 1.0)).otherwise(0.0)
             for d, w in zip(DIMENSIONS, whole)]
    # The widest dimension; of equally wide ones the first listed.
    widest = F.greatest(*ratio)
    axis = F.coalesce(*[F.when(r == widest, F.lit(d)) for r, d in zip(ratio, DIMENSIONS)])
    stats = plan.join(
        rows.groupBy("node").agg(F.sum("size").alias("total"), F.max("size").alias("largest"), *widths(rows)), "node"
    ).select("node", "right", "total", "largest", axis.alias("axis"),
             F.round(F.col("total") * F.col("share")).cast("long").alias("cut"))
    stats = F.broadcast(written(stats, "nodes"))

    open_rows = rows.join(stats, "node")
    number = F.when(F.col("axis") == "size", F.col("size")).when(F.col("axis") == "id", F.col("id")).otherwise(0)
    text = F.when(F.col("axis") == "source", F.col("source")).when(F.col("axis") == "lang", F.col("lang")).otherwise("")
    order = ["number", "text", "digest", "doc_id", "rid"]
    placed = running(
        open_rows.withColumns({"number": number, "text": text}), "node", order, F.col("size"), f"level-{level}")

    # The group of copies at the cut, one per node: a small one is not cut.
    end = F.col("before") + F.col("size")
    same = ["node", "number", "text", "digest"]
    at_cut = F.broadcast(placed.where((F.col("before") < F.col("cut")) & (F.col("cut") <= end)).select(same))
    edges = placed.join(at_cut, same).groupBy("node", "cut", "largest").agg(
        F.min("before").alias("from"), F.max(end).alias("to"))
    bound = F.greatest(F.lit(target / PIECES), F.col("largest"))
    near = F.when(F.col("cut") - F.col("from") <= F.col("to") - F.col("cut"), F.col("from")).otherwise(F.col("to"))
    moved = F.broadcast(edges.select(
        "node", F.when(F.col("to") - F.col("from") <= bound, near).otherwise(F.col("cut")).alias("at")))
    side = F.when(F.col("before") + end > 2 * F.coalesce("at", "cut"), F.col("right")).otherwise(F.col("node"))
    halves = placed.join(moved, "node", "left").withColumn("node", side).select(*rows.columns)
    done = rows.join(plan, "node", "left_anti")
    return halves.unionByName(done)


def kd_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
              overhead: int = 16) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every document.

    The number of shards is given, or follows from ``target_bytes``, the size to which leaves are
    split.  Size: UTF-8 bytes of the text plus ``overhead``.  The bytes of a shard come near total /
    shards: a cut lies within half a row of its quantile, or at the nearer edge of a group of equal texts, when
    that is no larger than a 64th of a shard or than the node's largest document.  So copies share a shard
    but for those that a cut divides.  ``slot`` counts the rows of a shard from 0 without a gap.

    A NULL text has no bytes and is no copy of the empty one; NULL or absent source and lang count as
    empty, a NULL doc_id as 0 and as the last of equal texts.  Equal rows take neighbouring slots in any order.
    An empty table gives no rows; with fewer rows than shards some shards stay empty.  Very long texts are
    hashed, not moved.  Other columns are not read.
    """
    spark = configure(docs.sparkSession)
    with scratch(spark):
        rows = written(narrow(docs, overhead).withColumn("node", F.lit(0)), "narrow", keep=True)
    first = rows.agg(F.sum("size"), *widths(rows)).first()
    total, whole = first[0] or 0, [w or 0.0 for w in first[1:]]
    if shards is None:
        shards = max(1, -(-total // target_bytes))
    nodes, level = [(0, shards)], 0
    while any(n > 1 for _, n in nodes):
        with scratch(spark):
            rows = written(split(rows, nodes, whole, level, total / shards), f"tree-{level}", keep=True)
        nodes = [part for at, n in nodes for part in ([(at, n // 2), (at + n // 2, n - n // 2)] if n > 1 else [(at, n)])]
        level += 1
    placed = running(rows.withColumnRenamed("node", "shard"), "shard", ["digest", "doc_id", "rid"], F.lit(1).cast("long"),
                     "slots")
    return placed.select("doc_id", "size", "text_crc32", "shard", F.col("before").alias("slot"))
