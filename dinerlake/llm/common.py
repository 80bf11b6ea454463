"""Helpers of the training-data operators: scratch tables, row numbers and splits by document id."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dinerlake.session import shared_dir

# Words of the size, window and mixing rules: everything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

# Rows and bytes handed to a Python task at once; long texts would otherwise fill its memory.
BATCH_ROWS, BATCH_BYTES = 1_000, 4 << 20


# Where this package lies, for the Python workers; where it is installed, this adds nothing.
HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def configure(spark: SparkSession) -> SparkSession:
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if HOME not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([HOME, *filter(None, paths)])
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


_scope: ContextVar[list[tuple[str, bool]] | None] = ContextVar("scratch tables", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables ``written`` inside go when the block ends well, but for those with ``keep``, which go
    with the block around it; after a failure they stay, to be looked at."""
    outer, own = _scope.get(), []
    token = _scope.set(own)
    try:
        yield
    finally:
        _scope.reset(token)
    for path, keep in own:
        if not keep:
            remove(spark, path)
        elif outer is not None:
            outer.append((path, False))


def remove(spark: SparkSession, path: str) -> None:
    """Deletes one scratch table."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def written(df: DataFrame, tag: str, keep: bool = False) -> DataFrame:
    """``df`` written once to the shared folder and reread, so that later steps neither
    recompute it nor depend on the executors that made it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/dinerlake-llm/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _scope.get() is not None:
        _scope.get().append((path, keep))
    return spark.read.schema(df.schema).parquet(path)


BITMAP = 1 << 15  # bits of one of Spark's bitmaps
MOST_BITS = 1 << 29  # of all bitmaps of one filter together: 64 MB


def marked(big: DataFrame, column: str, wanted: DataFrame, flag: str, most_bits: int = MOST_BITS) -> DataFrame:
    """``big`` with ``flag``: whether ``column`` may be among that of ``wanted`` (a written table).

    The flag is never false for a wanted row, and seldom true for another: a bitmap of key hashes decides,
    about 16 bits a key up to ``most_bits`` in all, so that the broadcast is bounded.  An exact join has
    to follow for the rows with the flag.  With more keys than that it only moves more rows.
    """
    keys = wanted.select(column).distinct()
    bits = min(most_bits, max(BITMAP, 1 << (16 * keys.count()).bit_length()))
    place = F.pmod(F.xxhash64(column), F.lit(bits))
    maps = keys.select(place.alias("place")).groupBy(F.shiftright("place", 15).alias("_map")).agg(
        F.bitmap_construct_agg(F.pmod("place", F.lit(BITMAP))).alias("_bits"))
    bit = F.pmod("_place", F.lit(BITMAP))
    byte = F.conv(F.hex(F.substring("_bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(bit, F.lit(8)))), F.lit(2)) == 1
    return (
        big.withColumn("_place", place)
        .join(F.broadcast(maps), F.shiftright("_place", 15) == F.col("_map"), "left")
        .select(*big.columns, F.coalesce(held, F.lit(False)).alias(flag))
    )


def thinned(big: DataFrame, column: str, wanted: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``big`` that ``marked`` lets through; no wanted row is lost."""
    return marked(big, column, wanted, "_may", most_bits).where("_may").drop("_may")


def numbered(df: DataFrame, tag: str) -> DataFrame:
    """A written copy of ``df`` with a unique long ``rid`` per row.

    Ids of the tables may be null or repeated; the number is fixed by the written copy.
    """
    return written(df.withColumn("rid", F.monotonically_increasing_id()), tag)


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4 (NULL for a NULL id)."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(fold(doc_id) == 2, F.lit(False))
