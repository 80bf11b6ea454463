import random

from dinerlake.llm.components import components, settled
from tests.llm.brute import Union

EDGE = "a long, b long"


def found(spark, edges):
    rows = components(spark.createDataFrame(edges, EDGE)).collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: r.root for r in rows}


def plain(edges):
    edges = [e for e in edges if e[0] != e[1]]
    union = Union({n for e in edges for n in e})
    for a, b in edges:
        union.join(a, b)
    return {n: union.find(n) for n in union.up}


def test_chains_stars_loops_and_repeats(spark):
    draw = random.Random(5)
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 140)]
    upside = [(199, i) for i in range(150, 199)]
    loose = [(draw.randrange(300, 420), draw.randrange(300, 420)) for _ in range(90)]
    edges = chain + star + upside + loose + [(500, 500), (601, 600), (601, 600), (600, 601)]
    draw.shuffle(edges)
    assert found(spark, edges) == plain(edges)


def test_stars_are_settled(spark):
    for edges, want in (([(2, 1), (3, 1), (3, 1)], True), ([], True), ([(1, 2)], False), ([(2, 1), (3, 2)], False),
                        ([(3, 1), (3, 2)], False), ([(5, 4), (2, 1)], True)):
        assert settled(spark.createDataFrame(edges, EDGE)) is want, edges
        assert found(spark, edges) == plain(edges)
