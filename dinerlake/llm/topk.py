"""Exact top-k search by inner product.

Vectors are packed into shards once, where they are read, and stay where they lie.  Queries are packed
into blocks; as many blocks as fit into ``PASS_BYTES`` go to every task at a time.  A task meets each
query block with each of its shards, as one tile: a matrix product, of which only what can still be
among the best k of its query is looked at.  One list per query and task leaves the task, and the lists
are merged in rounds of ``FAN_IN`` until one list per query is left.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dinerlake.llm.common import configure, scratch, written

QUERY_BLOCK, SHARD, FAN_IN = 1024, 4096, 32
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1

# Integers up to these bounds are exact as single and as double; half of what the types hold.
SINGLE, DOUBLE = 2.0**23, 2.0**52
# Rows of a like length lie together, so that a few huge ones do not cost the others the fast product.
SMALL, LARGE = 2.0**11, 2.0**26

# Bytes of one shard or query block, of the rows packed at once, and of the queries that are sent
# to every task at a time, with the lists that are kept for them there.
BLOCK_BYTES, HELD_BYTES, PASS_BYTES = 8 << 20, 16 << 20, 16 << 20
LIST_BYTES = 32  # of one entry of a list
ROWS_AT_ONCE = 1 << 16


def usable(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows without a NULL (read as NaN) or non-finite component; row i has the values from ends[i] on."""
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    return np.flatnonzero(bad[ends[1:]] == bad[ends[:-1]])


def squares(matrix: np.ndarray) -> np.ndarray:
    """Squared length of each row."""
    return np.einsum("ij,ij->i", matrix, matrix, dtype=np.float64)


def kind(scale: int) -> type:
    """How components of rows of this scale are kept."""
    return np.int16 if scale == 0 else np.float64


def shards(held: list[pa.RecordBatch], size: int) -> Iterator[tuple]:
    """Shards of up to ``size`` rows of one length and scale, each ordered by id."""
    table = pa.Table.from_batches(held).combine_chunks()
    vectors = table["embedding"].combine_chunks()
    starts, values = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
    good = usable(values, starts)
    values = np.floor(256.0 * values)
    known = table["vec_id"].is_valid().to_numpy()
    ids = table["vec_id"].fill_null(0).to_numpy()
    rids, dims, asked = (table[name].to_numpy() for name in ("rid", "dim", "asked"))
    order = good[np.lexsort((rids[good], ids[good], ~known[good], dims[good]))]
    for own in np.split(order, np.flatnonzero(np.diff(dims[order])) + 1) if len(order) else []:
        dim = int(dims[own[0]])
        matrix = values[starts[own][:, None] + np.arange(dim)]
        length = np.sqrt(squares(matrix))
        scales = (length >= SMALL).astype(int) + (length >= LARGE)
        most = max(1, min(size, BLOCK_BYTES // (8 * max(dim, 1))))
        for scale in np.unique(scales):
            rows = np.flatnonzero(scales == scale)
            for part in np.array_split(rows, -(-len(rows) // most)):
                at = own[part]
                yield (
                    dim, int(scale), int(asked[at].sum()), ids[at].tobytes(), known[at].tobytes(),
                    rids[at].tobytes(), asked[at].tobytes(), matrix[part].astype(kind(scale)).tobytes(),
                )


def packed(size: int):
    schema = pa.schema([
        ("dim", pa.int64()), ("scale", pa.int64()), ("n_asked", pa.int64()), ("ids", pa.binary()),
        ("known", pa.binary()), ("rids", pa.binary()), ("asked", pa.binary()), ("matrix", pa.binary()),
    ])

    def packs(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        found = list(shards(held, size))
        arrays = [pa.array([x[n] for x in found], field.type) for n, field in enumerate(schema)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, room = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held, rows, room = [*held, batch], rows + batch.num_rows, room + batch.nbytes
            if rows >= 8 * size or room >= HELD_BYTES:
                yield packs(held)
                held, rows, room = [], 0, 0
        if held:
            yield packs(held)

    return run


def asked_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The query rows of the shards, one by one."""
    for batch in batches:
        for tile in batch.to_pylist():
            rids = np.frombuffer(tile["rids"], dtype=np.int64)
            at = np.flatnonzero(np.frombuffer(tile["asked"], dtype=bool))
            matrix = np.frombuffer(tile["matrix"], dtype=kind(tile["scale"])).reshape(len(rids), tile["dim"])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(at), tile["dim"])), pa.array(np.full(len(at), tile["scale"])),
                pa.array(rids[at]), pa.array(np.frombuffer(tile["ids"], dtype=np.int64)[at]),
                pa.array([row.tobytes() for row in matrix[at]], pa.binary()),
            ], names=["dim", "scale", "rid", "vec_id", "vector"])


def pack(group: pd.DataFrame) -> pd.DataFrame:
    """One block of queries."""
    return pd.DataFrame({
        "dim": [int(group["dim"].iloc[0])],
        "q_scale": [int(group["scale"].iloc[0])],
        "q_block": [int(group["block"].iloc[0])],
        "q_ids": [group["vec_id"].to_numpy(dtype=np.int64).tobytes()],
        "q_rids": [group["rid"].to_numpy(dtype=np.int64).tobytes()],
        "q_matrix": [b"".join(group["vector"])],
    })


def products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond the long range they stop at its ends.

    No partial sum exceeds the product of the lengths, so a type that holds it is exact.
    """
    with np.errstate(over="ignore"):
        bound = np.sqrt(squares(queries).max(initial=0.0)) * np.sqrt(squares(shard).max(initial=0.0))
    if bound < SINGLE:
        return queries.astype(np.float32) @ shard.astype(np.float32).T
    if bound < DOUBLE:
        return queries.astype(np.float64) @ shard.astype(np.float64).T
    left = np.array([[int(x) for x in row] for row in queries], dtype=object)
    right = np.array([[int(x) for x in row] for row in shard], dtype=object)
    return np.clip(left @ right.T, LONG_MIN, LONG_MAX).astype(np.int64)


def fewer(rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of each row, ties to the earlier place; ``rows`` is sorted."""
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    places = []
    for a, b in zip(starts, np.append(starts[1:], len(rows)), strict=True):
        if b - a <= k:
            places.append(np.arange(a, b))
            continue
        values = scores[a:b]
        least = np.partition(values, len(values) - k)[len(values) - k]
        above, level = np.flatnonzero(values > least), np.flatnonzero(values == least)
        places.append(a + np.sort(np.concatenate([above, level[: k - len(above)]])))
    return np.concatenate(places)


class Tops:
    """The ``k`` best rows of every query of a block among the shards met so far, best first."""

    def __init__(self, ids: np.ndarray, rids: np.ndarray, matrix: np.ndarray, k: int) -> None:
        self.q_ids, self.q_rids, self.matrix, self.k = ids, rids, matrix, k
        self.count = np.zeros(len(rids), dtype=np.int64)
        self.score = np.full((len(rids), k), LONG_MIN, dtype=np.int64)
        self.ids, self.rids = (np.zeros((len(rids), k), dtype=np.int64) for _ in range(2))
        self.known = np.zeros((len(rids), k), dtype=bool)

    def bar(self, scores: np.ndarray) -> np.ndarray:
        """What a score has to reach; a bar that its type does not hold exactly is beyond all of ``scores``."""
        full = self.count == self.k
        lowest = LONG_MIN if scores.dtype == np.int64 else -np.inf
        bar = np.where(full, self.score[:, -1].astype(scores.dtype), lowest)
        new, n = np.flatnonzero(~full), scores.shape[1] - self.k - 1
        if n > 0 and len(new):  # a query may meet itself, so one more than k
            bar[new] = np.maximum(bar[new], np.partition(scores[new], n, axis=1)[:, n])
        return bar

    def meet(self, ids: np.ndarray, known: np.ndarray, rids: np.ndarray, matrix: np.ndarray) -> None:
        scores = products(self.matrix, matrix)
        bar = self.bar(scores)
        hot = np.flatnonzero(scores.max(axis=1) >= bar)
        i, j = np.divmod(np.flatnonzero(scores[hot] >= bar[hot, None]), len(rids))
        i = hot[i]
        value = scores[i, j].astype(np.int64)
        # At the bar, order decides; nothing is better than its own row, which is no answer.
        level = (self.count[i] == self.k) & (value == self.score[i, -1])
        if level.any():
            known_there, id_there, rid_there = self.known[i, -1], self.ids[i, -1], self.rids[i, -1]
            before = (known[j] > known_there) | (known[j] == known_there) & (
                (ids[j] < id_there) | (ids[j] == id_there) & (rids[j] < rid_there))
            level &= ~before
        use = np.flatnonzero(~level & (self.q_rids[i] != rids[j]))
        if len(use):
            use = use[fewer(i[use], value[use], self.k)]
            i, j = i[use], j[use]
            self.add(i, value[use], known[j], ids[j], rids[j])

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, ...]:
        """Row, score, known, id and number of each entry of the lists of ``rows``."""
        at, place = np.nonzero(np.arange(self.k) < self.count[rows][:, None])
        at = rows[at]
        return at, self.score[at, place], self.known[at, place], self.ids[at, place], self.rids[at, place]

    def add(self, *new: np.ndarray) -> None:
        old = self.entries(np.unique(new[0]))
        row, score, known, ids, rids = (np.concatenate(x) for x in zip(old, new, strict=True))
        order = np.lexsort((rids, ids, ~known, ~score, row))
        row = row[order]
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        place = np.arange(len(row)) - np.repeat(starts, np.diff(np.append(starts, len(row))))
        kept = place < self.k
        row, place, order = row[kept], place[kept], order[kept]
        self.score[row, place], self.known[row, place] = score[order], known[order]
        self.ids[row, place], self.rids[row, place] = ids[order], rids[order]
        np.maximum.at(self.count, row, place + 1)


def tile_tops(k: int):
    schema = pa.schema([
        ("query_rid", pa.int64()), ("query_id", pa.int64()),
        ("vec_rid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()),
    ])

    def block(tile: dict[str, pa.Scalar], side: str, dim: int) -> tuple[np.ndarray, ...]:
        def column(name: str, of: type) -> np.ndarray:
            held = tile[f"{side}_{name}"].as_buffer()
            return np.frombuffer(held.to_pybytes(), dtype=of)

        rids = column("rids", np.int64)
        matrix = column("matrix", kind(tile[f"{side}_scale"].as_py())).reshape(len(rids), dim)
        known = [column("known", bool)] if side == "c" else []
        return column("ids", np.int64), *known, rids, matrix

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: dict[tuple[int, int, int], Tops] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                tile = {name: batch.column(name)[at] for name in batch.schema.names}
                key = tuple(tile[name].as_py() for name in ("dim", "q_scale", "q_block"))
                if key not in tops:
                    tops[key] = Tops(*block(tile, "q", key[0]), k)
                tops[key].meet(*block(tile, "c", key[0]))
        for top in tops.values():
            for rows in np.array_split(np.arange(len(top.count)), -(-len(top.count) * k // ROWS_AT_ONCE)):
                i, score, known, ids, rids = top.entries(rows)
                yield pa.RecordBatch.from_arrays([
                    pa.array(top.q_rids[i]), pa.array(top.q_ids[i]),
                    pa.array(rids), pa.array(ids, mask=~known), pa.array(score),
                ], schema=schema)

    return run


def merged(lists: DataFrame, slots: int, k: int) -> DataFrame:
    """One list per query out of the lists of up to ``slots`` tasks."""
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last(), F.col("vec_rid")]
    while slots > FAN_IN:
        slots = -(-slots // FAN_IN)
        lists = lists.withColumn("slot", F.expr(f"slot div {FAN_IN}"))
        ranked = F.row_number().over(Window.partitionBy("query_rid", "slot").orderBy(*order))
        lists = lists.withColumn("rank", ranked).where(F.col("rank") <= k).drop("rank")
    ranked = F.row_number().over(Window.partitionBy("query_rid").orderBy(*order))
    return (
        lists.withColumn("rank", ranked).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, query_block: int = QUERY_BLOCK,
          shard: int = SHARD) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` best other rows of every query row.

    Components count as floor(256 x).  Vectors that are NULL or hold NULL or non-finite components
    take no part; a query meets the vectors of its own length.  A query's own row is left out, other
    rows with the same id are not.  Ties go to the smaller vec_id, NULL ids last, then to the earlier
    row.  Repeated query rows each get their list.  Scores beyond a long stop at its ends.  An empty
    table gives no rows; other columns are ignored.
    """
    spark = configure(vectors.sparkSession)
    rows = vectors.where(F.col("embedding").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.size("embedding").cast("long").alias("dim"),
        F.coalesce(is_query, F.lit(False)).alias("asked"),
        F.monotonically_increasing_id().alias("rid"),
    )
    c_schema = ("dim long, scale long, n_asked long, ids binary, known binary, rids binary, asked binary, "
                "matrix binary")
    q_schema = "dim long, q_scale long, q_block long, q_ids binary, q_rids binary, q_matrix binary"
    tasks = max(FAN_IN, spark.sparkContext.defaultParallelism)
    with scratch(spark):
        # The written copy fixes the row numbers.
        c = written(rows.mapInArrow(packed(shard), c_schema), "shards")
        asked, room, most = c.agg(
            F.sum("n_asked"), F.sum(F.expr(f"n_asked * (8 * dim + {LIST_BYTES * k})")), F.max("dim")).first()
        count = -(-(asked or 0) // query_block)
        count = max(count, -(-(asked or 0) * 8 * (most or 0) // BLOCK_BYTES))
        passes = min(count, -(-(room or 0) // PASS_BYTES))
        q = (
            c.where("n_asked > 0").select("dim", "scale", "ids", "rids", "asked", "matrix")
            .mapInArrow(asked_rows, "dim long, scale long, rid long, vec_id long, vector binary")
            .withColumn("block", F.pmod(F.xxhash64("rid"), F.lit(max(1, count))))
            .groupBy("dim", "scale", "block").applyInPandas(pack, q_schema)
        )
        q = written(q, "queries")
        c = c.select("dim", *(F.col(x).alias(f"c_{x}") for x in ("scale", "ids", "known", "rids", "matrix")))
        found = [spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")]
        for turn in range(passes):
            sent = F.broadcast(q.where(F.pmod("q_block", F.lit(passes)) == turn))
            lists = c.coalesce(tasks).join(sent, "dim").mapInArrow(
                tile_tops(k), "query_rid long, query_id long, vec_rid long, vec_id long, score long")
            lists = lists.withColumn("slot", F.spark_partition_id())
            found.append(written(merged(lists, tasks, k), "tops", keep=True))
    return reduce(DataFrame.union, found[1:] or found)
