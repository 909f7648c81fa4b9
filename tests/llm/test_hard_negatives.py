import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tidemark.llm import hard_negatives as H
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(rows, is_anchor, np_=5, nn=5, low=80, high=100, scale=256):
    """Every anchor against every row; rows of (id, label, vector)."""
    use = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(scale * x) for x in v]
        if sum(x * x for x in v) < 2**62:
            use.append((i, label, v))
    out = []
    for n, (i, label, v) in enumerate(use):
        if not is_anchor(i):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, other) for m, (j, other, w) in enumerate(use)
                  if m != n and len(w) == len(v)]
        positives = sorted(s[:2] for s in scored if s[2] == label)[:np_]
        for p, pid in positives:
            fit = sorted((s, j) for s, j, other in scored if other != label and low * -p <= 100 * -s <= high * -p)
            out += [(i, pid, r + 1, j, -p, -s) for r, (s, j) in enumerate(fit[:nn])]
    return sorted(out)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    for c in ("id", "cell", "rid", "at", "size", "norm", "v", "anchor", "n", "i"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def mined(df, anchor=None, **options):
    anchor = F.col("vec_id") % 100 == 0 if anchor is None else anchor
    return sorted(tuple(r) for r in H.hard_negatives(df, anchor, **options).collect())


def test_whole_table_equals_plain(spark):
    rows = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding)
            for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op13_hard_negatives"](spark, SF).collect())
    assert got == plain(rows, lambda i: i % 100 == 0)
    assert got


def test_clusters_blocks_and_pruning(spark, monkeypatch):
    """Clustered vectors, many blocks, cells that are not visited; the same rows."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(8, 12)) * 3
    rows = [(i, int(rng.integers(4)), (centres[i % 8] + rng.normal(size=12) * 0.2).tolist()) for i in range(900)]
    rows += [(i, i % 9 // 8, rows[3][2]) for i in range(900, 1200)]      # a vector with a quarter of all rows
    monkeypatch.setattr(H, "BLOCK_ROWS", 70)
    monkeypatch.setattr(H, "LEAST_ROWS", 1)
    monkeypatch.setattr(H, "BLOCK_ANCHORS", 3)
    monkeypatch.setattr(H, "WINDOW_ROWS", 8)
    monkeypatch.setattr(H, "BROADCAST_CELLS", 2)
    got = mined(frame(spark, rows), F.col("vec_id") % 20 == 0)
    assert got == plain(rows, lambda i: i % 20 == 0)


def test_windows_leave_out_rows():
    """Well separated clusters: most windows are beyond the bounds, none of them needed."""
    rng = np.random.default_rng(7)
    centres = np.eye(8) * 900
    x = np.rint(np.concatenate([c + rng.normal(size=(64, 8)) * 20 for c in centres])).astype(np.int64)
    norm = np.sqrt((x * x).sum(axis=1).astype(float))
    angle = H.angles_to(x, norm, np.eye(8)).astype(float)
    starts = np.arange(0, len(x), 64)
    low, high = np.minimum.reduceat(angle, starts), np.maximum.reduceat(angle, starts)
    small, large = np.minimum.reduceat(norm, starts), np.maximum.reduceat(norm, starts)
    least, most = H.score_bounds(angle, norm, low, high, small, large)
    scores = x @ x.T
    assert (np.maximum.reduceat(scores, starts, axis=1) <= most).all()
    assert (np.minimum.reduceat(scores, starts, axis=1) >= least).all()
    fifth = np.sort(scores, axis=1)[:, -6]
    assert (most >= fifth[:, None]).mean() < 0.2


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 6), st.integers(0, 10**6), st.sampled_from([3, 300, 10**6, 10**8]))
def test_bounds_hold(size, seed, spread):
    rng = np.random.default_rng(seed)
    x = rng.integers(-spread, spread + 1, size=(40, size))
    x[rng.integers(40)] = 0
    norm = np.sqrt((x.astype(float) ** 2).sum(axis=1))
    references = rng.normal(size=(5, size))
    references /= np.linalg.norm(references, axis=1)[:, None]
    angle = H.angles_to(x, norm, references).astype(float)
    starts = np.arange(0, 40, 4)
    cut = [f.reduceat(a, starts) for a in (angle, norm) for f in (np.minimum, np.maximum)]
    least, most = H.score_bounds(angle, norm, cut[0], cut[1], cut[2], cut[3])
    scores = (x.astype(object) @ x.T.astype(object)).astype(float)
    assert (np.maximum.reduceat(scores, starts, axis=1) <= most).all()
    assert (np.minimum.reduceat(scores, starts, axis=1) >= least).all()


def test_cases(spark):
    """Nulls, non-finite parts, zero, empty, unequal and huge vectors, ties, repeated rows and anchors."""
    rows = [(0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.5]), (2, 1, [0.9, 0.5]), (3, 2, [1.0, 0.45]),
            (4, 2, [1.0, 0.45]), (4, 2, [1.0, 0.45]), (5, None, [1.0, 0.5]), (6, 2, None), (7, 2, [1.0, None]),
            (8, 2, [float("nan"), 1.0]), (9, 2, [float("inf"), 1.0]), (None, 2, [1.0, 0.5]), (10, 2, [0.0, 0.0]),
            (11, 1, [0.0, 0.0]), (100, 2, [0.0, 0.0]), (200, 3, [1.0, 2.0, 3.0]), (12, 3, [1.0, 2.0, 3.0]),
            (13, 4, [0.9, 2.0, 3.0]), (300, 5, []), (14, 5, []), (15, 6, []), (16, 2, [1e300, 1.0]), (17, 1, [-1.0, -0.5]),
            (18, 2, [-1.0, -0.4]), (400, 7, [3e6, 1e6]), (19, 7, [2.9e6, 1e6]), (20, 8, [2.8e6, 1e6]),
            (21, 2, [0.7, 0.3]), (22, 2, [0.69, 0.31]), (23, 2, [0.72, 0.3]), (24, 2, [0.9, 0.44])]
    got = mined(frame(spark, rows))
    assert got == plain(rows, lambda i: i % 100 == 0)
    assert {g[0] for g in got} == {0, 100, 200, 300, 400}


def test_many_ties(spark):
    rows = [(i, i % 3, [0.5, 0.5, 0.1]) for i in range(60)]
    assert mined(frame(spark, rows), F.col("vec_id") % 10 == 0) == plain(rows, lambda i: i % 10 == 0)


def test_other_numbers_and_text_ids(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(3)), rng.normal(size=4).tolist()) for i in range(80)]
    options = dict(n_positives=2, n_negatives=3, low=50, high=90)
    got = mined(frame(spark, rows), F.col("vec_id") % 9 == 0, **options)
    assert got == plain(rows, lambda i: i % 9 == 0, 2, 3, 50, 90)
    named = frame(spark, rows).withColumn("vec_id", F.format_string("%04d", "vec_id"))
    got = mined(named, F.col("vec_id").cast("int") % 9 == 0, **options)
    assert [(int(a), int(b), c, int(d), *e) for a, b, c, d, *e in got] == plain(rows, lambda i: i % 9 == 0, 2, 3, 50, 90)


@pytest.mark.parametrize("rows", [[], [(1, 1, [1.0])], [(0, 1, [1.0])], [(0, None, None)]])
def test_empty(spark, rows):
    assert mined(frame(spark, rows)) == []
