import random

from tidemark.operators.components import components


def _brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in root}


def test_against_brute_force(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(i, i + 1) for i in range(200, 230)] + [(5, 5), (None, 4), (7, None)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == _brute(edges)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
