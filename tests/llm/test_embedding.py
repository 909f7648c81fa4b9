import math
import random

import numpy as np

from tidemark.llm.embedding_neardup import embedding_neardup, join_group

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, cid string, unit string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def brute(rows, cosine):
    def usable(r):
        v = r[1]
        return (r[2] is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)
                and any(v))
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(n):
        for j in range(i):
            a, b = rows[i], rows[j]
            if usable(a) and usable(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1], np.float32).astype(float), np.array(b[1], np.float32).astype(float)
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    p, q = find(i), find(j)
                    root[max(p, q)] = min(p, q)
    out = []
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((str(rows[i][0]), links[i], str(least), rows[i][0] == least))
    return sorted(out)


def result(df):
    return sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in df.collect())


def cloud(seed, n, dim=8, spread=0.25):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    return [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)], rng.choice([1, 1, 1, 2])) for i in range(n)]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    v = [1.0, 2.0, 3.0]
    rows = [(4, v, 1), (3, v, 1), (2, [2.0, 4.0, 6.0], 1), (1, v, 2), (9, v, None), (8, None, 1), (7, [0.0, 0.0, 0.0], 1),
            (6, [1.0, None, 3.0], 1), (5, [nan, 2.0, 3.0], 1), (10, [inf, 2.0, 3.0], 1), (11, [], 1), (12, [1.0, 2.0], 1),
            (13, [-0.0, 1.0, 0.0], 1), (14, [0.0, 1.0, 0.0], 1), (4, v, 1), (15, [3e38, 0.0, 0.0], 1),
            (16, [1e-40, 0.0, 0.0], 1)]
    assert result(embedding_neardup(table(spark, rows))) == brute(rows, 0.93)
    assert embedding_neardup(table(spark, [])).count() == 0
    alone = embedding_neardup(table(spark, [(None, v, 1), (None, None, None)]))
    assert [(r.n_links, r.component_id, r.kept) for r in alone.collect()] == [(0, None, True)] * 2


def test_cells_blocks_and_visits_equal_brute_force(spark):
    rows = cloud(1, 260)
    want = brute(rows, 0.93)
    assert sum(w[1] for w in want) > 500
    for cell_rows in (4096, 60, 15):
        assert result(embedding_neardup(table(spark, rows), cell_rows=cell_rows)) == want
    assert result(embedding_neardup(table(spark, rows), cell_rows=15, max_pivots=4)) == want


def test_chain_is_one_component(spark):
    rows = [(i, [math.cos(i * 0.3), math.sin(i * 0.3), 0.5], 1) for i in range(20)]
    assert result(embedding_neardup(table(spark, rows), cell_rows=5)) == brute(rows, 0.93)


def test_group_sides():
    x = np.eye(4)[[0, 0, 1, 1]]
    one = np.ones(4, np.int64)
    links, label = join_group(x, np.zeros(4), one, np.array([0, 1, 0, 1]), 0.9, 0.5)
    assert links.tolist() == [1, 1, 1, 1] and label.tolist() == [0, 0, 2, 2]
    links, _ = join_group(x, np.zeros(4), one, np.array([0, 0, 1, 1]), 0.9, 0.5)
    assert links.tolist() == [0, 0, 0, 0]
