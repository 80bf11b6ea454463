import random
from collections import Counter

import numpy as np
import pytest

from dinerlake.llm import bagminhash as B
from dinerlake.llm.components import components
from dinerlake.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.brute import Union, bag, classes, similarity


def signature(bags, size):
    doc = np.array([i for i, b in enumerate(bags) for _ in b])
    shingle = np.array([k for b in bags for k in b], dtype=np.uint64)
    weight = np.array([w for b in bags for w in b.values()])
    return B.signatures(doc, B.mixed(shingle) >> np.uint64(12), weight, len(bags), size)


@pytest.mark.parametrize("weights", [[1], [1, 2, 3, 5, 9], [40, 100, 7]])
def test_signatures_estimate_weighted_jaccard_without_bias(weights):
    rng = random.Random(4)
    for trial in range(4):
        one = Counter({rng.randrange(10**9): rng.choice(weights) for _ in range(60)})
        two = Counter({k: max(1, w + rng.choice([-1, 0, 0, 2])) for k, w in one.items() if rng.random() < 0.8})
        two.update({rng.randrange(10**9): rng.choice(weights) for _ in range(trial * 5)})
        true = similarity(one, two)
        sig = signature([one, two], 4096)
        assert abs((sig[0] == sig[1]).mean() - true) < 4 * (true * (1 - true) / 4096) ** 0.5 + 1e-9


def test_signature_holds_every_point_up_to_the_last_filled(monkeypatch):
    small = signature([Counter({1: 1})], 32)
    assert np.isfinite(small).all()
    monkeypatch.setattr(B.np, "log", lambda x, log=np.log: log(x))
    assert (small == signature([Counter({1: 1}), Counter({2: 3})], 32)[:1]).all()


def test_elements_make_the_multiset_overlap():
    texts = ["a b c d e f a b c d e g", "a b c d e f", "x y", "", None, "x y"]
    hashes, owner, counts = B.shingles(texts)
    doc, shingle, weight = B.bags(hashes, owner)
    assert [int(weight[doc == i].sum()) for i in range(6)] == [sum(bag(t).values()) for t in texts]
    assert counts.tolist() == [12, 6, 2, 0, 0, 2]
    digests = B.bag_digests(hashes, owner, 6)
    assert digests[2] == digests[5] != digests[0]


def test_query_against_plain_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = classes({d.doc_id: d.text for d in docs})
    got = {r.doc_id: r.class_id for r in QUERIES["op3_near_copies"](spark, SMALL).collect()}
    assert got == want and len(set(want.values())) < len(want)


def edited(rng, text, share):
    return [w if rng.random() > share else f"n{rng.randrange(10**6)}" for w in text]


def test_groups_chains_and_odd_rows(spark):
    rng = random.Random(7)
    base = [f"w{rng.randrange(500)}" for _ in range(300)]
    texts = {}
    for i in range(60):  # a large group of near copies, some of them further apart
        texts[i] = " ".join(edited(rng, base, rng.choice([0.0, 0.005, 0.01, 0.03, 0.05])))
    chain = [f"c{i}" for i in range(200)]
    for i in range(100, 112):  # neighbours are near, the ends are not
        texts[i] = " ".join(chain)
        at = (i - 100) * 15
        chain[at : at + 6] = [f"x{i}{j}" for j in range(6)]
    texts |= {200: "a b", 201: "A  b", 202: "", 203: None, 204: " \n", 205: "a b c d e a b c d e", 206: "a b c d e"}
    rows = [(i, t, "s", b"") for i, t in texts.items()] + [(205, texts[205], "s", b"")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, digest binary").repartition(5)
    got = B.near_copies(df).collect()
    want = classes(texts)
    assert {r.doc_id: r.class_id for r in got} == want
    size = Counter(want[i] for i, _, _, _ in rows)
    assert all(r.class_size == size[r.class_id] for r in got) and len(got) == len(rows)


def test_no_rows_and_null_ids(spark):
    schema = "doc_id long, text string"
    assert B.near_copies(spark.createDataFrame([], schema)).count() == 0
    got = B.near_copies(spark.createDataFrame([(None, "a b c"), (None, "a b c"), (3, "a b c")], schema)).collect()
    assert [(r.class_id, r.class_size) for r in got] == [(3, 3)] * 3


def test_components(spark):
    rng = random.Random(2)
    edges = [(f"{a:03}", f"{b:03}") for a, b in ((rng.randrange(150), rng.randrange(150)) for _ in range(90))]
    edges += [(f"{i}", f"{i + 1}") for i in range(500, 540)] + [("hub", f"{i:03}") for i in range(0, 20)]
    union = Union({x for e in edges for x in e})
    for a, b in edges:
        union.join(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: union.find(x) for x in linked}
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def moved(df):
    """The columns of every shuffle in the plan of ``df``."""
    plans, found = [df._jdf.queryExecution().executedPlan()], []
    while plans:
        plan = plans.pop()
        if plan.nodeName() == "Exchange":
            found.append({plan.output().apply(i).name() for i in range(plan.output().size())})
        plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return found


def test_texts_and_sets_move_no_more_than_needed(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(80)]
    rows = [(i, " ".join(edited(rng, base, 0.02))) for i in range(30)] + [(i, f"text {i} alone") for i in range(50, 60)]
    seen = {}
    monkeypatch.setattr(B, "written", lambda df, tag, *a, f=B.written, **k: (seen.setdefault(tag, moved(df)), f(df, tag, *a, **k))[1])
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        B.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum("text" in c for c in seen["sets"]) == 1
    assert sum(bool(c & {"a_set", "b_set", "elements"}) for c in seen["spokes"]) == 2
    assert not any("elements" in c for tag in ("sizes", "prefixes") for c in seen[tag])
