import random

import pytest
from ledgerwright.llm.common import components


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("edges", [
    [],
    [(i, i + 1) for i in range(40)],
    [(0, i) for i in range(1, 50)] + [(100, i) for i in range(101, 120)] + [(120, 5)],
    [(random.Random(k).randrange(60), random.Random(-k).randrange(60)) for k in range(1, 45)],
])
def test_components(spark, edges):
    edges = [(a, b) for a, b in edges if a != b]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == brute(edges)


def test_nulls_and_self_links_are_ignored(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 3), (4, 5), (4, 5)], "a long, b long")
    assert {tuple(r) for r in components(df).collect()} == {(5, 4), (4, 4)}
