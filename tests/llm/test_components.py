import random

import pytest

from pitchline.llm.components import components


@pytest.mark.parametrize("seed", range(2))
def test_random_graphs(spark, seed):
    r = random.Random(seed)
    edges = [(r.randint(0, 120), r.randint(0, 120)) for _ in range(80)]
    edges += [(500 + i, 501 + i) for i in range(30)] + [(900, 900 + i) for i in range(40)] + [(7, 7)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(up)}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
