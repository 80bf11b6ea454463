"""Ranked lexical search by the Best Position Algorithm.

The documents are read once into a forward table of the query terms they hold.  A task turns a run
of its rows into impact lists, one per term, highest impact first.  For every item it reads the lists
of the item's terms in step, looks up each new document in all of them at once, and keeps per
list the best position: the first one that is not yet seen, counted from the top.  What the lists hold
at their best positions bounds every unseen document; the item is done when that sum lies strictly below
the k-th score found so far, so no tie is lost.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from dinerlake.llm.common import configure, scratch, written

# Terms are runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z are folded.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)
PIECE_BYTES = 1 << 22  # of a text, split at once
BLOCK_TERMS = 1 << 20  # terms of the items that are searched together, summed over the items
SHARD_POSTINGS = 1 << 21  # postings of the documents whose lists lie in memory together
FIRST_STEP, LARGEST_STEP = 16, 1_024  # positions read per list before the bound is looked at again

FORWARD = "doc_id {kind}, n long, terms array<int>, tfs array<long>"
FOUND = "iid long, doc_id {kind}, score long"


def counted(text: bytes | None) -> tuple[int, Counter]:
    """Number of terms of a text and how often each occurs."""
    counts: Counter = Counter()
    total, folded, begin = 0, (text or b"").translate(FOLD), 0
    while begin < len(folded):
        end = folded.find(b" ", begin + PIECE_BYTES)
        end = len(folded) if end < 0 else end
        words = folded[begin:end].split()
        total += len(words)
        counts.update(words)
        begin = end
    return total, counts


def item_terms(items: DataFrame) -> DataFrame:
    """``iid, item_id, terms, counts``: the distinct terms of every item."""
    kind = items.schema["item_id"].dataType.simpleString()

    def read(batches):
        for batch in batches:
            found = [counted(t)[1] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("iid"), batch.column("item_id"),
                pa.array([list(c) for c in found], pa.list_(pa.binary())),
                pa.array([list(c.values()) for c in found], pa.list_(pa.int64())),
            ], ["iid", "item_id", "terms", "counts"])

    rows = items.select(
        F.monotonically_increasing_id().alias("iid"), "item_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(read, f"iid long, item_id {kind}, terms array<binary>, counts array<long>")


def forward(docs: DataFrame, places: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every document; of its terms only those with a place."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(places)

    def read(batches):
        place = shared.value
        for batch in batches:
            totals, ends, terms, tfs = [], [0], [], []
            for text in batch.column("text"):
                total, counts = counted(text.as_py())
                for term, tf in counts.items():
                    at = place.get(term)
                    if at is not None:
                        terms.append(at)
                        tfs.append(tf)
                totals.append(total)
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(totals, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64())),
            ], ["doc_id", "n", "terms", "tfs"])

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(read, FORWARD.format(kind=kind))


class Top:
    """The k best documents of one item: higher scores first, then smaller ids, NULL last."""

    def __init__(self, k: int):
        self.k, self.rows, self.floor = k, [], 0

    def add(self, scores: np.ndarray, ids: list) -> None:
        self.rows += [(-int(s), i is None, i) for s, i in zip(scores, ids)]
        self.rows.sort(key=lambda r: r if r[2] is not None else (*r[:2], 0))
        del self.rows[self.k:]
        if len(self.rows) == self.k:
            self.floor = -self.rows[-1][0]


class Shard:
    """Impact lists of a run of documents, and the way back from a document into all lists."""

    def __init__(self, ids: list, n: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tfs: np.ndarray,
                 weights: np.ndarray, docs: int, words: int):
        # Python's integers: the product may pass 64 bits in a very large corpus.
        length = np.array([25 + 75 * int(x) * docs // words for x in n], dtype=np.int64)
        doc = np.repeat(np.arange(len(ids)), sizes)
        impact = weights[terms] * (1_000_000_000 * tfs // (1_000 * tfs + 8 * length[doc]))
        held = impact > 0
        self.ids = ids
        self.doc, self.term, self.impact = doc[held], terms[held], impact[held]
        self.row = np.searchsorted(self.doc, np.arange(len(ids) + 1))
        self.order = np.lexsort((-self.impact, self.term))
        self.first = np.searchsorted(self.term[self.order], np.arange(len(weights) + 1))
        self.position = np.empty(len(self.order), dtype=np.int64)
        self.position[self.order] = np.arange(len(self.order)) - self.first[self.term[self.order]]
        self.column = np.full(len(weights), -1, dtype=np.int64)
        self.met = np.zeros(len(ids), dtype=bool)

    def search(self, terms: np.ndarray, times: np.ndarray, top: Top) -> int:
        """Adds the shard's best documents to ``top``; returns how many it has looked up."""
        begin, size = self.first[terms], self.first[terms + 1] - self.first[terms]
        terms, times, begin, size = (x[size > 0] for x in (terms, times, begin, size))
        if not len(terms):
            return 0
        self.column[terms] = np.arange(len(terms))
        self.met[:] = False
        at = np.concatenate([[0], np.cumsum(size)])
        seen = np.zeros(at[-1], dtype=bool)
        best = np.zeros(len(terms), dtype=np.int64)
        depth, step, looked_up = 0, FIRST_STEP, 0
        while True:
            # Sorted access: the next positions of every list.
            reads = [self.order[b + depth:b + min(depth + step, s)] for b, s in zip(begin, size) if depth < s]
            docs = np.unique(self.doc[np.concatenate(reads)])
            docs = docs[~self.met[docs]]
            self.met[docs] = True
            looked_up += len(docs)
            if len(docs):
                # Direct access: all postings of the new documents, with their positions.
                width = self.row[docs + 1] - self.row[docs]
                own = np.repeat(np.arange(len(docs)), width)
                posting = np.repeat(self.row[docs] - np.cumsum(width) + width, width) + np.arange(width.sum())
                column = self.column[self.term[posting]]
                own, posting, column = (x[column >= 0] for x in (own, posting, column))
                seen[at[column] + self.position[posting]] = True
                scores = np.zeros(len(docs), dtype=np.int64)
                np.add.at(scores, own, self.impact[posting] * times[column])
                good = np.flatnonzero((scores > 0) & (scores >= top.floor))
                if len(good) > top.k:
                    least = np.partition(scores[good], len(good) - top.k)[len(good) - top.k]
                    good = good[scores[good] >= least]
                if len(good):
                    top.add(scores[good], [self.ids[docs[g]] for g in good])
            depth += step
            step = min(2 * step, LARGEST_STEP)
            bound = 0
            for c in range(len(terms)):
                if best[c] < size[c]:
                    rest = seen[at[c] + best[c]:at[c + 1]]
                    gap = int(rest.argmin())
                    best[c] = size[c] if rest[gap] else best[c] + gap
                if best[c] < size[c]:
                    bound += int(times[c]) * int(self.impact[self.order[begin[c] + best[c]]])
            if bound < top.floor or bound == 0:
                break
        self.column[terms] = -1
        return looked_up


def shards(batches: Iterator, weights: np.ndarray, docs: int, words: int) -> Iterator[Shard]:
    held, postings = [], 0

    def closed() -> Shard:
        ids = [i for b in held for i in b.column("doc_id").to_pylist()]
        terms, tfs = ([b.column(c) for b in held] for c in ("terms", "tfs"))
        return Shard(
            ids, np.concatenate([b.column("n").to_numpy() for b in held]),
            np.concatenate([pc.list_value_length(t).to_numpy(zero_copy_only=False) for t in terms]),
            np.concatenate([t.flatten().to_numpy() for t in terms]).astype(np.int64),
            np.concatenate([t.flatten().to_numpy() for t in tfs]), weights, docs, words)

    for batch in batches:
        held.append(batch)
        postings += len(batch.column("terms").flatten())
        if postings >= SHARD_POSTINGS:
            yield closed()
            held, postings = [], 0
    if held:
        yield closed()


def search_block(docs: DataFrame, block: list, k: int) -> DataFrame:
    """The best documents of every task for the items of one block."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    places = {t: i for i, t in enumerate(sorted({t for r in block for t in r["terms"]}))}
    index = written(forward(docs, places), "forward")
    n_docs, n_words = index.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    weights = np.zeros(len(places), dtype=np.int64)
    for term, df in index.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    items = [
        (r["iid"], np.array([places[t] for t in r["terms"]], dtype=np.int64),
         np.array(r["counts"], dtype=np.int64)) for r in block
    ]
    shared = docs.sparkSession.sparkContext.broadcast((items, weights))
    number = docs.schema["doc_id"].dataType

    def search(batches):
        items, weights = shared.value
        tops = [Top(k) for _ in items]
        for shard in shards(batches, weights, n_docs, n_words):
            for (_, terms, times), top in zip(items, tops):
                shard.search(terms, times, top)
        rows = [(iid, doc_id, -score) for (iid, _, _), top in zip(items, tops) for score, _, doc_id in top.rows]
        for begin in range(0, len(rows), 10_000):
            part = list(zip(*rows[begin:begin + 10_000]))
            yield pa.RecordBatch.from_arrays([
                pa.array(part[0], pa.int64()), pa.array(part[1], to_arrow_type(number)),
                pa.array(part[2], pa.int64())], ["iid", "doc_id", "score"])

    found = index.where(F.size("terms") > 0).mapInArrow(search, FOUND.format(kind=kind))
    return ranked(found, k).drop("rank")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """Ranks per item; Spark keeps the first k of every input partition before the shuffle."""
    best = Window.partitionBy("iid").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: for every item the ``k`` documents of the highest score above 0.

    All documents count, whole texts are read.  A NULL or empty text has no terms.  Equal scores are
    ranked by ascending id, NULL ids last; rows that repeat an id are ranked one after the other.  An item
    without terms, or whose terms no document holds, has no rows; a repeated item has its rows once per
    row.  Empty tables give no rows.  Other columns are not read.  Very long texts are split in
    pieces, only their counts lie in memory.

    Items are searched in blocks of about ``block_terms`` terms (one item at least); what a task
    holds is bounded by that and by ``SHARD_POSTINGS``, not by the table.
    """
    spark = configure(docs.sparkSession)
    listed = written(item_terms(items).where(F.size("terms") > 0), "items")
    total = listed.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_terms))
    block_of = F.pmod(F.xxhash64("iid"), F.lit(n_blocks))
    found = []
    for number in range(n_blocks):
        with scratch(spark):
            block = listed.where(block_of == number).select("iid", "terms", "counts").collect()
            if block:
                found.append(written(search_block(docs, block, k), "found", keep=True))
    if not found:
        found = [spark.createDataFrame([], FOUND.format(kind=docs.schema["doc_id"].dataType.simpleString()))]
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    return ranked(every, k).join(listed.select("iid", "item_id"), "iid").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
