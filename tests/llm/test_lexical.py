import math
import re
from collections import Counter

import numpy as np

from dinerlake.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string, size int", "item_id long, text string, rank int"
WORDS = "alpha beta gamma delta épsilon zeta eta theta iota kappa Ünder 漢字 x1 42".split()


def fold(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    """Every document is scored for every item."""
    held = [(d, Counter(fold(t))) for d, t, _ in docs]
    n_docs = sum(1 for _, c in held if c)
    words = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    rows = []
    for item, text, _ in items:
        scores = []
        for d, c in held:
            m = 25 + 75 * sum(c.values()) * n_docs // words if words else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t in fold(text) if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        rows += [(item, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k])]
    return sorted(rows, key=repr)


def texts(count, seed, longest=30):
    rng = np.random.default_rng(seed)
    odds = 1 / np.arange(1, len(WORDS) + 1)
    return [
        " ,-".join(w.upper() if rng.random() < 0.2 else w
                   for w in rng.choice(WORDS, rng.integers(0, longest), p=odds / odds.sum()))
        for _ in range(count)]


def got(spark, docs, items, **options):
    found = lexical.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **options)
    return sorted((tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def cases():
    docs = [(i, t, 0) for i, t in enumerate(texts(300, 1))]
    # Ties, repeated rows, NULL ids and texts, no terms, one very long text.
    docs += [(900, "alpha beta", 1)] * 15 + [(i, "alpha beta", 1) for i in range(880, 895)]
    docs += [(None, "gamma gamma", 2), (None, None, 3), (901, None, 4), (902, "", 5), (903, "--- ...", 6)]
    docs += [(904, "kappa 42 " * 700_000 + "Zeta", 7)]
    items = [(i, t, 0) for i, t in enumerate(texts(25, 2, 12))]
    items += [(50, "alpha alpha alpha beta", 1), (51, None, 1), (52, "", 1), (53, "unheard of", 1),
              (None, "gamma 漢字", 1), (54, "zeta 42", 1), (54, "zeta 42", 1)]
    return docs, items


def test_against_plain_scores(spark):
    docs, items = cases()
    assert got(spark, docs, items) == plain(docs, items)


def test_blocks_and_small_shards(spark, monkeypatch):
    docs, items = cases()
    assert got(spark, docs, items, block_terms=40, k=3) == plain(docs, items, 3)


def test_empty_tables(spark):
    docs, items = cases()
    assert got(spark, [], items) == []
    assert got(spark, docs, []) == []
    assert got(spark, [(1, None, 0)], items) == []


def test_it_stops_early_and_keeps_ties():
    rng = np.random.default_rng(5)
    size, words = 5_000, 6
    tfs = np.minimum(rng.zipf(1.5, (size, words)), 60)
    held = rng.random((size, words)) < 0.4
    held[:, 0] = True
    held[:30], tfs[:30] = True, 200  # documents that stand high in every list
    ids, sizes = list(range(size)), held.sum(1)
    terms = np.nonzero(held)[1]
    n = (tfs * held).sum(1) + 1_300
    n[:30] = 1_200
    weights = np.array([900, 800, 700, 2000, 3000, 100])
    shard = lexical.Shard(ids, n, sizes, terms, tfs[held], weights, size, int(n.sum()))
    top = lexical.Top(10)
    looked_up = shard.search(np.arange(words), np.ones(words, dtype=np.int64), top)
    scores = np.zeros(size, dtype=np.int64)
    np.add.at(scores, shard.doc, shard.impact)
    best = sorted((-int(s), i) for i, s in enumerate(scores))[:10]
    assert [(s, i) for s, _, i in top.rows] == best
    assert looked_up < size / 10
