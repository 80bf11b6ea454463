import random

from dinerlake.llm import decontaminate as D
from dinerlake.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.brute import item_words, least_edits


def brute(texts, items):
    out = set()
    known = [(i, item_words(t)) for i, t in items if t is not None and i is not None]
    for doc, text in texts:
        words = item_words(text)
        for i, w in known:
            # an item of n words with k edits keeps n - k of them
            if w and sum(x in set(words) for x in w) >= len(w) - D.limit(len(w)):
                if least_edits(w, words) <= D.limit(len(w)):
                    out.add((doc, i))
    return out


def test_query_against_plain_version(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [d for d in docs if d[1] is None or len(d[1]) < 6_000]
    want = brute(docs, items)
    kept = {d[0] for d in docs}
    got = QUERIES["op8_leaks"](spark, SMALL).collect()
    assert {(r.doc_id, r.item_id) for r in got if r.doc_id in kept} == want and want


def test_edits_reach_the_target_recall():
    rng = random.Random(5)
    pool = [f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{i % 30}" for i in range(900)]
    items = [" ".join(rng.choice(pool) for _ in range(rng.randrange(12, 50))) for _ in range(40)]
    known = D.Items(list(range(40)), items)
    found = wanted = 0
    texts, want = [], []
    for i, item in enumerate(items):
        for share in (0.0, 0.05, 0.1, 0.2):
            words = item.split()
            for _ in range(int(share * len(words))):
                at, op = rng.randrange(len(words)), rng.choice("sid")
                words[at : at + (op != "i")] = [rng.choice(pool)] if op != "d" else []
            around = [" ".join(rng.choice(pool) for _ in range(30)) for _ in range(2)]
            texts.append(f"{around[0]} {' '.join(words).upper()}, {around[1]}")
            want.append(i)
    for i, text, got in zip(want, texts, D.leaks(texts, known), strict=True):
        wanted += 1
        found += i in {g[0] for g in got}
        for item, start, n, edits in got:
            stretch = item_words(text)[start : start + n]
            whole = item_words(items[item])
            assert edits == least_edits(whole, stretch) == least_edits(whole, item_words(text))
    assert found >= 0.97 * wanted


def test_odd_items_and_texts(spark):
    docs = spark.createDataFrame(
        [(1, "say one two three four five six seven again", 0), (2, None, 0), (3, "", 0), (None, "solo", 0),
         (4, "ein zwei drei", 0), (4, "ein zwei drei", 0), (5, "one two three four five", 0)],
        "doc_id long, text string, leaks int")
    items = spark.createDataFrame(
        [(10, "One two, three four five six seven!"), (11, "one two three four five six seven"), (12, ""), (13, None),
         (None, "ein zwei drei"), (14, "SOLO"), (15, "zwei drei")], "item_id long, text string")
    for block in (1, 2, 100):
        got = sorted(((r.doc_id, r.item_id, r.start, r.words, r.edits)
                      for r in D.leaked_pairs(docs, items, block).collect()), key=str)
        assert got == [(1, 10, 1, 7, 0), (1, 11, 1, 7, 0), (4, 15, 1, 2, 0), (4, 15, 1, 2, 0), (None, 14, 0, 1, 0)]
    assert D.leaked_pairs(docs, items.limit(0)).count() == 0
    assert D.leaked_pairs(docs.limit(0), items).count() == 0


def test_passage_in_a_very_long_text():
    item = " ".join(f"q{i}" for i in range(30))
    text = " ".join(f"w{i % 977}" for i in range(150_000)) + " " + item + " " + "tail " * 50_000
    assert D.leaks([text], D.Items([7], [item])) == [[(7, 150_000, 30, 0)]]


def test_recall_at_the_limit_by_length():
    rng = random.Random(11)
    pool = [f"w{i}x" for i in range(3_000)]
    for n, trials in ((5, 60), (15, 60), (30, 60), (59, 60), (120, 40), (250, 30), (500, 15)):
        items = [[rng.choice(pool) for _ in range(n)] for _ in range(trials)]
        known = D.Items(list(range(trials)), [" ".join(i) for i in items])
        for ops in ("sid", "s", "i", "d"):
            texts = []
            for item in items:
                words = list(item)
                for _ in range(D.limit(n)):
                    at, op = rng.randrange(len(words)), rng.choice(ops)
                    words[at : at + (op != "i")] = [rng.choice(pool)] if op != "d" else []
                around = [" ".join(rng.choice(pool) for _ in range(40)) for _ in range(2)]
                texts.append(f"{around[0]} {' '.join(words)} {around[1]}")
            found = sum(i in {g[0] for g in got} for i, got in enumerate(D.leaks(texts, known)))
            assert found >= 0.97 * trials - 1, (n, ops, found, trials)


def test_items_without_an_id_remove_their_documents(spark):
    docs = spark.createDataFrame(
        [(1, "ein zwei drei vier"), (2, "solo"), (3, None), (4, ""), (5, "nothing of it"), (None, "and solo too")],
        "doc_id long, text string")
    items = spark.createDataFrame([(None, "zwei drei"), (7, "Solo"), (8, None)], "item_id long, text string")
    for block in (1, 2, 100):
        assert sorted(r.doc_id for r in D.without_leaks(docs, items, block).collect()) == [3, 4, 5]
    assert D.without_leaks(docs, items.limit(0)).count() == 6


def test_one_block_at_a_time(spark, monkeypatch):
    """A block's result is written before the next block is embedded."""
    events = []
    monkeypatch.setattr(D, "written", lambda df, tag, f=D.written: (events.append("written"), f(df, tag))[1])
    monkeypatch.setattr(D, "Items", lambda ids, texts, f=D.Items: (events.append("items"), f(ids, texts))[1])
    docs = spark.createDataFrame([(1, "one two three four")], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"one two {w}") for i, w in enumerate(("three", "six", "ten"))], "item_id long, text string")
    D.without_leaks(docs, items, 1).count()
    assert events == ["items", "written"] * 3
    D.leaked_pairs(docs, items, 1).count()
    assert events[6:] == ["items", "written"] * 3
