import random

import numpy as np
from pyspark.sql import functions as F

from dinerlake.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, k, asked):
    good = [(n, i, [np.floor(256 * float(np.float32(x))) for x in v]) for n, (i, v, _) in enumerate(rows)
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, i, q in good:
        if i is None or not asked(i):
            continue
        found = [(-sum(int(a) * int(b) for a, b in zip(q, v, strict=True)), j is None, j or 0, m)
                 for m, j, v in good if m != n and len(v) == len(q)]
        for rank, (score, none, j, _) in enumerate(sorted(found)[:k], 1):
            out.append((i, rank, None if none else j, -score))
    return sorted(out, key=str)


def run(spark, rows, **sizes):
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k=3, **sizes)
    return sorted((tuple(r) for r in got.collect()), key=str)


def made(n, dim, seed):
    rng = random.Random(seed)
    return [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(dim)], 0) for i in range(n)]


def test_ties_odd_rows_and_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(topk, "FAN_IN", 2)
    rows = made(60, 3, 1) + [
        (None, [0.5, 0.5, 0.5], 0), (61, None, 0), (62, [None, 0.1, 0.1], 0), (65, [float("nan"), 0.0, 0.0], 0),
        (70, [float("inf"), 0.0, 0.0], 0), (75, [0.5, 0.5], 0), (76, [0.1, 0.5], 0), (80, [], 0), (81, [], 0),
        (10, [0.5, 0.5, 0.5], 0), (10, [0.5, 0.5, 0.5], 0),
    ]
    assert run(spark, rows, query_block=4, shard=7) == plain(rows, 3, lambda i: i % 5 == 0)


def test_one_row_and_no_row(spark):
    assert run(spark, []) == []
    assert run(spark, [(5, [0.1], 0)]) == []


def test_large_components_stay_exact(spark):
    rows = [(5, [3e6, 1.0], 0), (6, [3e6, 2.0], 0), (7, [3e6, 3.0], 0)]
    assert run(spark, rows) == plain(rows, 3, lambda i: i % 5 == 0)
    huge = run(spark, [(5, [3e30], 0), (6, [3e30], 0), (7, [-3e30], 0)])
    assert [(r[2], r[3]) for r in huge] == [(6, 2**63 - 1), (7, -(2**63))]


def shuffled(spark):
    """Bytes of the shuffle files that lie on this machine."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = {files.apply(n).getName(): files.apply(n).length() for n in range(files.size())}
    return {name: size for name, size in found.items() if name.startswith("shuffle_")}


def test_vectors_are_not_moved_for_each_query_block(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(rng.normal(0, 0.2, (1500, 64)))]
    before = set(shuffled(spark))
    key = "spark.sql.autoBroadcastJoinThreshold"  # as with tables that are larger than it
    held = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        got = run(spark, rows, query_block=10, shard=50)
    finally:
        spark.conf.set(key, held)
    moved = sum(size for name, size in shuffled(spark).items() if name not in before)
    assert len(got) == 900
    assert moved < 2 * 4 * 64 * len(rows)  # twice the input; 30 blocks of queries by 30 shards were 30 times


def test_the_driver_sends_each_query_once_and_few_at_a_time(spark, monkeypatch):
    sent, send = [], F.broadcast

    def spy(df):
        sent.append(df.agg(F.sum(F.length("q_matrix"))).first()[0] or 0)
        return send(df)

    monkeypatch.setattr(topk.F, "broadcast", spy)
    monkeypatch.setattr(topk, "PASS_BYTES", 6_000)
    rows = made(400, 3, 5)
    assert run(spark, rows, query_block=4, shard=20) == plain(rows, 3, lambda i: i % 5 == 0)
    assert sum(sent) == 80 * 3 * 2  # two bytes a component, whatever the number of shards
    assert len(sent) == 2 and max(sent) < 400


def test_passes_scales_and_many_ties(spark, monkeypatch):
    monkeypatch.setattr(topk, "PASS_BYTES", 2_000)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    rows = made(90, 3, 2) + [(200 + i, [0.5, 0.5, 0.5], 0) for i in range(40)]
    rows += [(300 + i, [(i - 5) * 100.0, 30.0, 1.0], 0) for i in range(12)]
    rows += [(400 + i, [i * 1e6, -3e5, 1.0], 0) for i in range(6)]
    rows += [(500 + i, [0.25, 0.5], 0) for i in range(4)] + [(None, [0.5, 0.5, 0.5], 0)] * 3
    random.Random(4).shuffle(rows)
    assert run(spark, rows, query_block=4, shard=7) == plain(rows, 3, lambda i: i % 5 == 0)


def test_lists_by_shard_equal_one_sort():
    rng = np.random.default_rng(7)
    for width, k in ((1, 1), (2, 3), (6, 4)):
        matrix = rng.integers(-2, 3, (150, width)).astype(float)
        ids, known, rids = rng.integers(0, 20, 150), rng.random(150) < 0.8, rng.permutation(150)
        ids[~known] = 0
        tops = topk.Tops(ids[:20], rids[:20], matrix[:20], k)
        for part in np.array_split(rng.permutation(150), 9):
            part = part[np.lexsort((rids[part], ids[part], ~known[part]))]
            tops.meet(ids[part], known[part], rids[part], matrix[part])
        scores = (matrix[:20] @ matrix.T).astype(int)
        for i in range(20):
            order = [j for j in np.lexsort((rids, ids, ~known, -scores[i])) if j != i][:k]
            assert list(tops.rids[i]) == list(rids[order]) and list(tops.score[i]) == list(scores[i, order])
