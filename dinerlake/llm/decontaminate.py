"""Benchmark decontamination by the CGK random-walk embedding.

Texts and items are sequences of words (lower case).  An item leaks if some stretch of a document is within
``limit(n)`` word edits of the item's n words.  Every window of an item's size is considered; one
that holds too few of the items' word pairs to be that near (an edit breaks two pairs at most) is put
aside by counting, which loses none.
The others go through the CGK embedding: a pointer walks over the words, and at each step outputs the
word and moves on or stays by a random bit of (step, word).  Two sequences with few edits give
outputs with few differing positions, so a few sampled positions, repeated ``REPEATS`` times, bring near
pairs together (the bit-sampling LSH).  The walks drift apart with the number of edits, so an item of more than
``PART_WORDS`` words is looked for by parts: at most 20% edits in all leave some part with at most 20% of its
own.  Every candidate is then checked by its exact edit distance to the whole item.

Documents are never shuffled: the items are a query set, handed out in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dinerlake.llm.common import marked, written
from dinerlake.llm.words import ALNUM, U, Words, chunks, mixed, split


MAX_EDITS = 0.2  # of an item's words
REPEATS, SAMPLED = 24, 3
PART_WORDS = 24  # longest piece that is embedded; recall at the limit falls with its length
STEPS = 3  # steps of the walk per word
BLOCK_ITEMS = 2_000
CHUNK_BYTES = 2 << 20  # characters per walk; longer runs share the cost of its steps
CLASS_RATIO = 1.15  # window sizes of one class differ by this factor at most

LEAKS = "array<struct<item_id:long,start:int,words:int,edits:int>>"


def limit(n: int) -> int:
    """Most word edits at which an item of ``n`` words still counts as leaked."""
    return int(MAX_EDITS * n)


@cache
def salts(repeat: int, log_steps: int) -> np.ndarray:
    """An odd number per step of the walk."""
    return mixed((U(repeat) << U(32)) + np.arange(1 << log_steps, dtype=U)) | U(1)


def walk_salts(repeat: int, steps: int) -> np.ndarray:
    return salts(repeat, max(8, steps.bit_length()))


def sampled_steps(n: int, repeat: int) -> list[int]:
    """The output positions that the repeat looks at, for windows of at least ``n`` words."""
    return sorted(np.random.default_rng([n, repeat]).choice(STEPS * n, SAMPLED, replace=False).tolist())


def embed(words: np.ndarray, starts: np.ndarray, stop: np.ndarray, steps: list[int], repeat: int,
          shown: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Keys of the sampled outputs for the windows from ``starts`` to ``stop``, which of them are
    left, and the words seen.  ``words`` ends with a 0 that belongs to no window.

    With ``shown``, a window whose sampled word no item shows at that position is not followed
    further: it can match none.
    """
    pointer, which = starts.copy(), np.arange(len(starts))
    key = np.zeros(len(starts), dtype=U)
    salt = walk_salts(repeat, steps[-1])
    step, outputs = 0, []
    for index, wanted in enumerate(steps):
        for step in range(step, wanted):
            # The random bit of (step, word): 1 moves the pointer on, up to the window's end.
            move = (words[pointer] * salt[step]) >> U(63)
            pointer = np.minimum(pointer + move.view(np.int64), stop)
        step = wanted
        seen = np.where(pointer < stop, words[pointer], U(0))
        key = mixed(key * U(3) + seen + U(index + 1))
        outputs.append(seen)
        if shown is not None:
            known = shown[index]
            keep = known[np.minimum(np.searchsorted(known, seen), len(known) - 1)] == seen
            pointer, stop, key, which = pointer[keep], stop[keep], key[keep], which[keep]
    return key, which, outputs


class Known:
    """Membership in a set of 64-bit hashes."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.sorted = np.unique(hashes)
        self.flags = np.zeros(1 << 18, dtype=bool)
        self.flags[(self.sorted >> U(46)).astype(np.int64)] = True

    def counts(self, hashes: np.ndarray) -> np.ndarray:
        """Running count of members; entry i counts those before place i."""
        member = self.flags[(hashes >> U(46)).astype(np.int64)]
        hit = np.flatnonzero(member)
        if len(hit):
            place = np.minimum(np.searchsorted(self.sorted, hashes[hit]), len(self.sorted) - 1)
            member[hit] = self.sorted[place] == hashes[hit]
        return np.concatenate([[0], np.cumsum(member, dtype=np.int32)])


def pairs(hashes: np.ndarray) -> np.ndarray:
    """A hash for each word and the one after it."""
    return mixed(hashes[:-1] * U(0x9E3779B97F4A7C15) + hashes[1:])


@dataclass
class SizeClass:
    """Parts of items, of like size."""

    span: int  # words that hold a stretch near any of them
    least: int  # word pairs (words, for parts of one word) that must be known
    single: bool
    known: Known
    # per repeat: sampled steps, words shown at them, sorted keys, the part of each key
    tables: list[tuple] = field(default_factory=list)


class Items:
    """The embedded items of one block."""

    def __init__(self, ids: list[int], texts: list[str]) -> None:
        found: dict[bytes, int] = {}
        self.ids: list[list[int]] = []
        self.words: list[np.ndarray] = []
        all_words = split(texts, ALNUM, lower=True)
        for i, item in enumerate(ids):
            words = all_words.hashes[all_words.of(i)]
            if not len(words):
                continue
            place = found.setdefault(words.tobytes(), len(self.words))
            if place == len(self.words):
                self.words.append(words)
                self.ids.append([])
            self.ids[place].append(item)
        self.own_pairs = [np.unique(pairs(w)) for w in self.words]
        # (item, first word, words) of each part that is embedded
        self.parts = [
            (i, int(p[0]), words[p[0] : p[-1] + 1]) for i, words in enumerate(self.words)
            for p in np.array_split(np.arange(len(words)), -(-len(words) // PART_WORDS))
        ]
        self.classes = [self.size_class(group) for group in self.by_size()]

    def by_size(self) -> list[list[int]]:
        groups: list[list[int]] = []
        sizes = [len(words) for _, _, words in self.parts]
        for i in sorted(range(len(sizes)), key=lambda i: sizes[i]):
            if groups and sizes[i] <= CLASS_RATIO * sizes[groups[-1][0]]:
                groups[-1].append(i)
            else:
                groups.append([i])
        return groups

    def size_class(self, group: list[int]) -> SizeClass:
        parts = [self.parts[i][2] for i in group]
        sizes = np.array([len(p) for p in parts])
        shortest, longest = int(sizes.min()), int(sizes.max())
        single = shortest == 1
        least = 1 if single else min(int(n) - 1 - 2 * limit(int(n)) for n in sizes)
        known = Known(np.concatenate(parts if single else [pairs(p) for p in parts]))
        made = SizeClass(longest + limit(longest), least, single, known)
        words = np.concatenate([*parts, np.zeros(1, dtype=U)])
        stop = np.cumsum(sizes)
        for repeat in range(REPEATS):
            # Sampling stays where the walk is still inside the shortest part.
            steps = sampled_steps(max(1, int(0.6 * shortest)), repeat)
            key, _, outputs = embed(words, stop - sizes, stop, steps, repeat)
            order = np.argsort(key, kind="stable")
            made.tables.append((
                steps, [np.unique(seen) for seen in outputs], key[order], np.array(group)[order]))
        return made


def nearest(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """Least edits between the item and a stretch of ``words``; the stretch's start and end."""
    n = len(words)
    costs = np.zeros(n + 1, dtype=np.int64)
    begins = np.arange(n + 1)
    places = np.arange(n + 1)
    for word in item:
        replace = costs[:-1] + (words != word)
        drop = costs[1:] + 1
        best = np.minimum(replace, drop)
        begin = np.where(replace <= drop, begins[:-1], begins[1:])
        best = np.concatenate([[costs[0] + 1], best])
        begin = np.concatenate([[0], begin])
        # insertions: the least of best[j] + (i - j) over j <= i
        shifted = best - places
        running = np.minimum.accumulate(shifted)
        source = np.maximum.accumulate(np.where(shifted == running, places, 0))
        costs, begins = running + places, begin[source]
    end = int(costs.argmin())
    return int(costs[end]), int(begins[end]), end


def candidates(words: Words, items: Items) -> dict[tuple[int, int], list[int]]:
    """Where items would start, per (text, item) that the LSH brings together."""
    hashes = words.hashes
    if not items.words or not len(hashes):
        return {}
    last_word = np.repeat(words.first[1:], np.diff(words.first))
    doubles, padded = pairs(hashes), np.append(hashes, U(0))
    found: dict[tuple[int, int], set[int]] = {}
    for group in items.classes:
        stop = np.minimum(np.arange(group.span, group.span + len(hashes)), last_word)
        if group.single:
            counts = group.known.counts(hashes)
            starts = np.flatnonzero(counts[stop] - counts[:-1] >= group.least)
        else:
            counts = group.known.counts(doubles)
            starts = np.flatnonzero(counts[stop - 1] - counts >= group.least)
        if not len(starts):
            continue
        for repeat, (steps, shown, keys, owners) in enumerate(group.tables):
            key, which, _ = embed(padded, starts, stop[starts], steps, repeat, shown)
            first, last = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
            for at in np.flatnonzero(last > first):
                start = int(starts[which[at]])
                text = int(np.searchsorted(words.first, start, "right")) - 1
                for part in owners[first[at] : last[at]]:
                    owner, offset, _ = items.parts[part]
                    found.setdefault((text, owner), set()).add(start - offset)
    return {pair: sorted(at) for pair, at in found.items()}


def leaks(texts: list[str | None], items: Items) -> list[list[tuple[int, int, int, int]]]:
    """Per text: item_id, first word, number of words and edits of each leaked item's best stretch."""
    words = split(texts, ALNUM, lower=True)
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
    for (text, owner), starts in candidates(words, items).items():
        item, own = items.words[owner], words.of(text)
        n, most = len(item), limit(len(item))
        best, checked = None, -1
        for start in starts:
            # The part may be out of its place by the edits before it, and the window by those in it.
            if start + n + 2 * most <= checked:
                continue  # the stretch checked last holds every match of this window
            checked = start + 2 * n + 2 * most
            low, high = max(own.start, start - 2 * most), min(own.stop, checked)
            stretch = words.hashes[low:high]
            if n > 1 and np.isin(items.own_pairs[owner], pairs(stretch)).sum() < (
                len(items.own_pairs[owner]) - 2 * most
            ):
                continue  # too few pairs in common: every edit breaks two at most
            edits, begin, end = nearest(item, stretch)
            if edits <= most and (best is None or edits < best[0]):
                best = (edits, low + begin - own.start, end - begin)
        if best is not None:
            out[text] += [(i, best[1], best[2], best[0]) for i in items.ids[owner]]
    return [sorted(found) for found in out]


def leak_column(items: Items, text: str) -> Column:
    @F.pandas_udf(LEAKS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = [x for _, some in chunks(texts.tolist(), CHUNK_BYTES) for x in leaks(some, items)]
            yield pd.Series(found, dtype=object)

    return run(F.col(text))


def item_blocks(benchmark: DataFrame, size: int) -> Iterator[Items]:
    """The items in blocks of about ``size``, one at a time: neither a task nor the driver holds more."""
    rows = benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select(
        "item_id", "text")
    count = max(1, -(-rows.count() // size))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for i in range(count):
        chosen = sorted((r.item_id, r.text) for r in rows.where(block == i).collect())
        yield Items([c[0] for c in chosen], [c[1] for c in chosen])


def without_leaks(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK_ITEMS) -> DataFrame:
    """The documents that hold no item, also none of those with a NULL id; all rows and columns of the
    others stay, NULL and empty texts too.  An empty benchmark or table changes nothing."""
    benchmark = benchmark.select(F.coalesce("item_id", F.lit(-1).cast("long")).alias("item_id"), "text")
    digest = F.unhex(F.md5(F.col("text").cast("binary")))

    def found(items: Items) -> DataFrame:
        return docs.where(F.size(leak_column(items, "text")) > 0).select(digest.alias("_leaked")).distinct()

    # A block's result, the digests of the texts that leak, is written before the next block is read.
    leaked = reduce(DataFrame.unionByName, (
        written(found(items), "leakless") for items in item_blocks(benchmark, block)))
    flagged = marked(docs.withColumn("_digest", digest), "_digest", leaked.withColumnRenamed("_leaked", "_digest"), "_may")
    kept = flagged.where("_may").join(leaked, F.col("_digest") == F.col("_leaked"), "left_anti")
    return flagged.where("not _may").unionByName(kept).select(*docs.columns)


def leaked_pairs(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK_ITEMS) -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, start, words, edits.

    NULL and empty texts have none; items without a word or with a NULL id or text are left out.  Equal
    items are all reported.  Repeated rows each get their result; other columns are ignored.
    """
    def found(items: Items) -> DataFrame:
        leak = F.explode(leak_column(items, "text")).alias("leak")
        return docs.select("doc_id", leak).select("doc_id", "leak.*")

    # A block's result is written before the next block is read.
    return reduce(DataFrame.unionByName, (
        written(found(items), "leaks") for items in item_blocks(benchmark, block)))
