"""Removal of repeated passages.

Every window of 35 words has a Rabin-Karp hash.  Windows that occur more than once, anywhere, are counted
in Spark, and the words that they cover form the maximal intervals to remove.

Most windows are unique, and that shows without sending them: the smallest hash of the 8-word runs inside a
window (its anchor) is the same wherever the window occurs.  Anchors are about 7% of all places; they are
counted first, and only windows whose anchor repeats are hashed with 128 bits and counted themselves.
Equal texts are handled once, with their number as weight.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dinerlake.llm.common import written
from dinerlake.llm.words import BASE, OTHER_BASE, U, Words, chunks, powers_for, split

WINDOW, RUN = 35, 8
TOP = U(2**64 - 1)


def rolling(hashes: np.ndarray, size: int, base: np.uint64 = BASE) -> np.ndarray:
    """Rabin-Karp hash of every run of ``size`` words, modulo 2^64."""
    forward, backward = powers_for(len(hashes) + 1, base)
    sums = np.zeros(len(hashes) + 1, dtype=U)
    np.cumsum(hashes * forward[:-1], out=sums[1:])
    return (sums[size:] - sums[:-size]) * backward[: len(hashes) - size + 1]


def sliding(values: np.ndarray, size: int, pick: np.ufunc) -> np.ndarray:
    """Least (or greatest) of every ``size`` neighbours, by doubling."""
    have = 1
    while 2 * have <= size:
        values = pick(values[:-have], values[have:])
        have *= 2
    return pick(values[: len(values) - (size - have)], values[size - have :]) if have < size else values


class Passages:
    """Run hashes and window anchors of the texts of one chunk."""

    def __init__(self, words: Words, window: int, run: int) -> None:
        self.words, self.window = words, window
        self.places = window - run + 1  # runs inside a window
        n = len(words.hashes)
        self.windows = max(0, n - window + 1)
        if not self.windows:
            return
        self.runs = rolling(words.hashes, run)
        last = np.repeat(words.first[1:], np.diff(words.first))
        self.valid = np.arange(self.windows) + window <= last[: self.windows]
        self.least = sliding(self.runs, self.places, np.minimum)
        self.least[~self.valid] = 0

    def anchors(self) -> np.ndarray:
        """Places of the runs that are the smallest of some window, ties included."""
        if not self.windows:
            return np.zeros(0, dtype=np.int64)
        pad = np.zeros(self.places - 1, dtype=U)
        highest = sliding(np.concatenate([pad, self.least, pad]), self.places, np.maximum)
        return np.flatnonzero((highest == self.runs) & (self.runs > 0))

    def anchored(self, marked: np.ndarray) -> np.ndarray:
        """Windows with a smallest run among the ``marked`` places."""
        if not self.windows:
            return np.zeros(0, dtype=np.int64)
        runs = np.full(len(self.runs), TOP)
        runs[marked] = self.runs[marked]
        return np.flatnonzero((sliding(runs, self.places, np.minimum) == self.least) & self.valid)


PROFILE = pa.schema([
    ("doc_id", pa.int64()), ("digest", pa.binary()), ("n_words", pa.int64()), ("whole", pa.string()),
    ("anchors", pa.list_(pa.int64())), ("places", pa.list_(pa.int32())),
])
SUSPECT = pa.schema([
    ("digest", pa.binary()), ("copies", pa.int64()), ("text", pa.string()),
    ("starts", pa.list_(pa.int32())), ("high", pa.list_(pa.int64())), ("low", pa.list_(pa.int64())),
])
REMOVED = pa.schema([("digest", pa.binary()), ("n_removed", pa.int64()), ("kept", pa.string())])


def sha_of(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.cumsum([0, *(len(p) for p in parts)]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat).cast(kind))


def profiles(window: int, run: int):
    """Per document: number of words, digest of all words, and its anchors."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for begin, some in chunks(texts):
                words = split(some)
                passages = Passages(words, window, run)
                at = passages.anchors()
                bounds = np.searchsorted(at, words.first)
                values = passages.runs[at].view(np.int64) if len(at) else at
                parts = list(zip(bounds[:-1], bounds[1:], strict=True))
                own = batch.slice(begin, len(some))
                yield pa.RecordBatch.from_arrays([
                    own.column("doc_id"), own.column("digest"),
                    pa.array(np.diff(words.first).astype(np.int64)),
                    pa.array([sha_of(t.encode("utf-8", "surrogatepass").split() if t else [])
                              for t in some]),
                    lists([values[a:b] for a, b in parts], pa.int64()),
                    lists([at[a:b] - words.first[i] for i, (a, b) in enumerate(parts)], pa.int32()),
                ], schema=PROFILE)
    return work


def suspects(window: int, run: int):
    """Per text with repeated anchors: the windows on them, with 128-bit hashes."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            marks = batch.column("places").to_pylist()
            for begin, some in chunks(texts):
                words, other = split(some), split(some, base=OTHER_BASE)
                passages = Passages(words, window, run)
                marked = np.concatenate([
                    np.array(m, dtype=np.int64) + words.first[i]
                    for i, m in enumerate(marks[begin : begin + len(some)])
                ])
                at = passages.anchored(marked)
                bounds = np.searchsorted(at, words.first)
                parts = list(zip(bounds[:-1], bounds[1:], strict=True))
                if len(at):
                    high = rolling(words.hashes, window)[at].view(np.int64)
                    low = rolling(other.hashes, window, OTHER_BASE)[at].view(np.int64)
                else:
                    high = low = at
                own = batch.slice(begin, len(some))
                yield pa.RecordBatch.from_arrays([
                    own.column("digest"), own.column("copies"), own.column("text"),
                    lists([at[a:b] - words.first[i] for i, (a, b) in enumerate(parts)], pa.int32()),
                    lists([high[a:b] for a, b in parts], pa.int64()),
                    lists([low[a:b] for a, b in parts], pa.int64()),
                ], schema=SUSPECT)
    return work


def covered(starts: list[int], n: int, window: int) -> np.ndarray:
    """Which of ``n`` words lie in a window at one of ``starts``: the merged removal intervals."""
    change = np.zeros(n + 1, dtype=np.int64)
    at = np.unique(np.array(starts, dtype=np.int64))
    change[at] += 1
    change[at + window] -= 1
    return np.cumsum(change[:-1]) > 0


def removals(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, kept = [], []
            for text, starts in zip(batch.column("text").to_pylist(),
                                    batch.column("starts").to_pylist(), strict=True):
                words = text.encode("utf-8", "surrogatepass").split()
                gone = covered(starts, len(words), window)
                counts.append(int(gone.sum()))
                kept.append(" ".join(
                    w.decode("utf-8", "surrogatepass") for w, out in zip(words, gone, strict=True)
                    if not out))
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64()), pa.array(kept, pa.string())],
                schema=REMOVED)
    return work


def remove_repeats(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """One row per document: doc_id, digest (of its text), n_words, n_removed, and for documents that
    lose words ``kept``, the remaining words joined by one space, else NULL; ``whole`` is the SHA-256
    of all words so joined.

    Words are split at ASCII white space only.  A window counts as repeated if its word sequence starts
    anywhere else, in the same document too; windows are judged on the input.  Texts under ``window``
    words lose nothing.  NULL and empty texts have no words.  Repeated rows are copies of each other.
    An empty table gives no rows; other columns are ignored.
    """
    if not 0 < run <= window:
        raise ValueError("a run must fit into the window")
    digest = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    source = docs.select(F.col("doc_id").cast("long"), "text", digest.alias("digest"))
    every = written(
        source.mapInArrow(
            profiles(window, run),
            "doc_id long, digest binary, n_words long, whole string, anchors array<long>, "
            "places array<int>",
        ),
        "profiles",
    )
    long = every.where(F.col("n_words") >= window)
    pairs = long.select(
        "digest", F.inline(F.arrays_zip(F.col("anchors").alias("anchor"), F.col("places").alias("place"))),
    ).toDF("digest", "anchor", "place")
    often = written(
        pairs.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"),
        "anchors",
    )
    # Equal texts once, with their number; the one with the least id stands for them.
    marked = written(
        pairs.join(often, "anchor").groupBy("digest").agg(F.collect_set("place").alias("places"))
        .join(long.groupBy("digest").agg(
            F.count("*").alias("copies"), F.min("doc_id").alias("keeper")), "digest"),
        "marked",
    )
    chosen = (
        source.join(marked, "digest")
        .where((F.col("copies") == 1) | F.col("doc_id").eqNullSafe(F.col("keeper")))
        .select("digest", "copies", "text", "places")
    )
    windows = written(
        chosen.mapInArrow(
            suspects(window, run),
            "digest binary, copies long, text string, starts array<int>, high array<long>, "
            "low array<long>",
        ),
        "windows",
    )
    flat = windows.select(
        "digest", "copies", F.inline(F.arrays_zip(
            F.col("high").alias("high"), F.col("low").alias("low"), F.col("starts").alias("start"))),
    ).toDF("digest", "copies", "high", "low", "start")
    repeated = written(
        flat.groupBy("high", "low").agg(F.sum("copies").alias("n")).where("n > 1")
        .select("high", "low"),
        "repeated",
    )
    starts = written(
        flat.join(repeated, ["high", "low"]).groupBy("digest")
        .agg(F.collect_set("start").alias("starts")),
        "starts",
    )
    removed = written(
        windows.select("digest", "text").join(starts, "digest").mapInArrow(
            removals(window), "digest binary, n_removed long, kept string")
        .groupBy("digest").agg(F.max("n_removed").alias("n_removed"), F.any_value("kept").alias("kept")),
        "removed",
    )
    return every.join(removed, "digest", "left").select(
        "doc_id", "digest", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        "kept", "whole",
    )
