import random

from tidemark.llm.common import connected_components


def brute(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in pairs:
        if a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {x: find(x) for x in root}


def components(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    found = {r.node: r.component for r in connected_components(df).collect()}
    return {**found, **{c: c for c in found.values()}}


def test_shapes(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1001 + i) for i in range(50)] + [(999, 1050)]
    loops = [(5000, 5000), (-3, 7), (7, -3), (-3, 7)]
    mess = [(2000 + rng.randrange(80), 2000 + rng.randrange(80)) for _ in range(70)]
    pairs = chain + star + loops + mess
    rng.shuffle(pairs)
    assert components(spark, pairs) == brute(pairs)


def test_none(spark):
    assert components(spark, []) == {}
    assert components(spark, [(3, 3)]) == {}
