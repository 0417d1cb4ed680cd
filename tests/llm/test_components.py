import random

import pytest

from nightloom.llm.components import components
from nightloom.llm.workspace import Workspace


def brute(edges):
    root = {v: v for e in edges for v in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    return root


@pytest.mark.parametrize("small", [0, 100, 10**6])
def test_components(spark, small):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(400, 700)] + [(i, i + 1) for i in range(40)] + [(1000, 1001 + i) for i in range(300)] + [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)] + [(-5, 7000), (7000, 6000), (50, 50), (None, 3)]
    rng.shuffle(edges)
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long").repartition(5), Workspace(spark, "test"), small=small).collect()}
    want = brute([e for e in edges if None not in e and e[0] != e[1]])
    assert got == want


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long"), Workspace(spark, "test")).count() == 0
