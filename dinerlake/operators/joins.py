"""Key joins that survive a hot key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_to_unique(
    left: DataFrame, unique: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Join ``left`` to a side that was aggregated to one row per key.

    Such an aggregate is already distributed by the key columns, so a plain join
    reuses that layout and the adaptive planner can neither split a hot partition
    nor switch to a hash join: both need a shuffle directly below each side.  The
    keys as one struct, after a hash to sort by, give the sides shuffles of their
    own, also where a layout by some of the keys would do.  The extra shuffle moves the
    aggregated side only, and a key that holds a large part of ``left`` is then split
    over many tasks.  NULL keys match nothing, as in a plain join.
    """
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    own = F.when(known, F.hash(*keys)).alias("_key_hash"), F.struct(*keys).alias("_key")
    sides = [df.select(*own, *[c for c in df.columns if c not in keys]) for df in (left, unique)]
    payload = [] if how in ("left_semi", "left_anti") else [c for c in unique.columns if c not in keys]
    joined = sides[0].join(sides[1], ["_key_hash", "_key"], how)
    kept = {k: F.col(f"_key.{k}").alias(k) for k in keys}
    return joined.select(*[kept.get(c, F.col(c)) for c in left.columns], *payload)


def keep_matching(left: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``keys_of`` (semi join).

    The keys are made distinct first: copies then collapse before the shuffle.
    """
    return join_to_unique(left, keys_of.select(*keys).distinct(), keys, "left_semi")


def drop_matching(left: DataFrame, keys_of: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key does not occur in ``keys_of`` (anti join)."""
    return join_to_unique(left, keys_of.select(*keys).distinct(), keys, "left_anti")


def drop_older(df: DataFrame, newest: DataFrame, keys: Sequence[str], column: str, last: str) -> DataFrame:
    """Rows of ``df`` but those whose key has a greater ``last`` in ``newest`` (one row per key).

    Keys are compared as columns, NULL with NULL.
    """
    key_hash = F.xxhash64(*keys).alias("_key_hash")
    left = df.select("*", key_hash).alias("l")
    right = newest.select(*keys, last, key_hash).alias("r")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in keys]
    older = F.coalesce(F.col(f"l.{column}") < F.col(f"r.{last}"), F.lit(False))
    met = [F.col("l._key_hash") == F.col("r._key_hash"), *same, older]
    return left.join(right, met, "left_anti").drop("_key_hash")
