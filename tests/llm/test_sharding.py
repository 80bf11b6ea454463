import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from dinerlake.llm import sharding

SCHEMA = "doc_id long, text string, source string, lang string, size int, node string, shard double, part int"


def rows(found):
    return [tuple(r) for r in found.select("doc_id", "size", "text_crc32", "shard", "slot").collect()]


def documents(count=600, seed=4):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(rng.pareto(1.1, count) * 200 + 1, 20_000).astype(int)
    docs = [
        (i, f"{i} " + "ä" * int(n), f"s{rng.integers(9)}", str(rng.choice(["en", "de"])), 1, "n", 1.0, 2)
        for i, n in enumerate(lengths)
    ]
    # Copies with other sources, a third of all rows in one group, NULLs, repeated rows, no text.
    docs += [(1_000 + i, "a copy of one text " * 20, f"s{i % 9}", "en", 0, None, None, None) for i in range(count // 2)]
    docs += [(2_000 + i, f"pair {i // 2} " * 30, f"s{i % 5}", None, 0, None, None, None) for i in range(100)]
    docs += [(None, "no id", None, None, 0, None, None, None)] * 3 + [(5, None, "s1", "en", 0, None, None, None)] * 2
    docs += [(6, "", "s1", "en", 0, None, None, None)] * 2
    return docs


def check(docs, found, shards):
    size_of = lambda t: len((t or "").encode()) + 16
    wanted = Counter((d[0], size_of(d[1]), zlib.crc32((d[1] or "").encode())) for d in docs)
    assert Counter(r[:3] for r in found) == wanted
    slots, sizes = defaultdict(list), Counter()
    for _, size, _, shard, slot in found:
        slots[shard].append(slot)
        sizes[shard] += size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(shards))
    return sizes


@pytest.mark.parametrize("shards", [1, 7, 16])
def test_bytes_are_near_equal(spark, shards):
    docs = documents()
    found = rows(sharding.kd_shards(spark.createDataFrame(docs, SCHEMA), shards=shards))
    sizes = check(docs, found, shards)
    mean = sum(sizes.values()) / shards
    largest = max(r[1] for r in found)
    assert len(sizes) == shards and max(abs(s - mean) for s in sizes.values()) <= largest


def test_copies_share_a_shard_but_at_cuts(spark):
    docs = documents()
    found = rows(sharding.kd_shards(spark.createDataFrame(docs, SCHEMA), shards=8))
    of = defaultdict(set)
    for doc_id, _, crc, shard, _ in found:
        of[crc].add(shard)
    pairs = {zlib.crc32(d[1].encode()) for d in docs if d[1] and d[1].startswith("pair")}
    assert all(len(of[c]) == 1 for c in pairs)
    assert sum(len(s) > 1 for s in of.values()) <= 7  # at most one group per cut


def test_target_bytes_reruns_and_partitions(spark):
    docs = documents(200)
    table = spark.createDataFrame(docs, SCHEMA)
    total = sum(len((d[1] or "").encode()) + 16 for d in docs)
    once = rows(sharding.kd_shards(table, target_bytes=total // 5))
    again = rows(sharding.kd_shards(table.repartition(7), target_bytes=total // 5))
    assert Counter(once) == Counter(again) and max(r[3] for r in once) == 5


def test_few_rows_and_empty_table(spark):
    table = spark.createDataFrame([(1, "a", "x", "y"), (2, None, None, None), (None, "b" * 3_000_000, "x", "y")],
                                  "doc_id long, text string, source string, lang string")
    found = rows(sharding.kd_shards(table, shards=9))
    check([(1, "a"), (2, None), (None, "b" * 3_000_000)], found, 9)
    assert rows(sharding.kd_shards(table.limit(0), shards=4)) == []
    assert len(rows(sharding.kd_shards(table.drop("source", "lang"), shards=2))) == 3


def test_native(spark):
    from dinerlake.llm.queries import QUERIES
    from tests.conftest import SMALL
    plan = QUERIES["op11_shards"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
