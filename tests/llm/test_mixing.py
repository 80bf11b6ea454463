from collections import Counter, defaultdict

import pytest

from dinerlake.llm.mixing import mix, source_targets
from tests.llm.brute import mixed

SCHEMA = "doc_id long, text string, source string"


def rows(df):
    return Counter(tuple(r) for r in df.select("doc_id", "size", "source_size", "target", "taken").collect())


def rounded(found):
    return Counter((a, b, c, round(d, 6), e) for (a, b, c, d, e), n in Counter(found).items() for _ in range(n))


DOCS = (
    [(i, "w " * (i % 7), "a") for i in range(60)]
    + [(100 + i, "x\ty\n" * 5, "b") for i in range(9)]
    + [(200 + i, "z " * 40, "c") for i in range(5)]
    + [(300, "tiny", "d"), (301, None, "d"), (302, "", "e"), (None, "no id", "a"), (5, "w " * 5, "a")]
    + [(400, "null source here", None), (401, "  one word", None), (7, "same", "a"), (7, "same", "a")]
)


def test_against_plain_version(spark):
    got = rows(mix(spark.createDataFrame(DOCS, SCHEMA)))
    assert rounded(got.elements()) == rounded(mixed(DOCS))


def test_budgets_are_met_exactly(spark):
    by = defaultdict(list)
    for r in mix(spark.createDataFrame(DOCS, SCHEMA)).collect():
        by[r.source].append(r)
        assert 0 <= r.taken <= 2 * r["size"]
    for found in by.values():
        assert sum(r.taken for r in found) == int(found[0].target + 1e-9)
    total = sum(len((t or "").replace("\t", " ").split(" ")) for _, t, _ in DOCS)
    assert total > 0


def test_excess_goes_to_the_others(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), ("d", 50)], "source string, source_size long")
    got = {r.source: r.target for r in source_targets(sizes, (5, 2, 1), 1.5, 2).collect()}
    # 3,090 words: a and d fill at 20 and 100, then b at 2,000; c takes the rest.
    assert got == {"a": 20.0, "d": 100.0, "b": 1980.0, "c": 990.0}


def test_reruns_agree_and_order_does_not_matter(spark):
    one = rows(mix(spark.createDataFrame(DOCS, SCHEMA)))
    two = rows(mix(spark.createDataFrame(DOCS[::-1], SCHEMA).repartition(5)))
    assert one == two


@pytest.mark.parametrize("docs", [[], [(1, None, None)], [(1, "", "a"), (2, None, "a")]])
def test_nothing_to_take(spark, docs):
    got = mix(spark.createDataFrame(docs, SCHEMA)).collect()
    assert len(got) == len(docs) and all(r.taken == 0 for r in got)


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", "s", 5, "k", 3.0)],
                               SCHEMA + ", size long, key string, target double")
    assert [(r.doc_id, r["size"], r.taken) for r in mix(df).collect()] == [(1, 2, 3)]
