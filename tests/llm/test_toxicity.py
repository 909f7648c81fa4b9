import random
import zlib

import numpy as np
import pytest

from tidemark.llm.toxicity import Terms, build_index, calibrate, drop_toxic, terms_of, toxicity

BAD = ["vilecur", "wretchling", "fouldolt", "scabrag"]


def prose(rng, n=30):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(500):
        w = prose(rng)
        toxic = i % 5 == 0
        if toxic:
            for b in rng.sample(BAD, 2):
                w.insert(rng.randrange(len(w)), b + rng.choice(["", "s", "ish"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    return rows, labels


def frames(spark, docs, rows, labels):
    lab = spark.createDataFrame([(*x, "clash") for x in labels], "doc_id long, toxic int, text string")
    return docs(rows), lab


def test_held_out_accuracy_and_columns(spark, docs, tables):
    rows, labels = tables
    extra = rows + [(None, rows[0][1]), (900, None), (901, ""), (0, rows[0][1]), (902, "clean " * 30_000)]
    df, lab = frames(spark, docs, extra, labels + [(None, 1), (3, None), (4, 0)])
    got = toxicity(df, lab).collect()
    assert len(got) == len(extra)
    truth = dict(labels)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        for e in r.evidence.split():
            key, cosine, label = e.split(":")
            assert zlib.crc32(key.encode()) % 3 != 1 and 0 < float(cosine) <= 1.0001 and int(label) == truth[int(key)]
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    score = {}
    for r, (_, t) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0)),
                         sorted(extra, key=lambda r: (r[0] is None, r[0] or 0))):
        assert score.setdefault(t, r.score) == r.score  # the text alone decides
    kept = drop_toxic(df, lab)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(
        str(r.doc_id) for r in got if not r.predicted)


def test_held_out_labels_change_nothing(spark, docs, tables):
    rows, labels = tables
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    one, two = ({r.doc_id: r.score for r in toxicity(*frames(spark, docs, rows[:200], x)).collect()}
                for x in (labels, flipped))
    assert one == two


def test_without_labels(spark, docs, tables):
    df, lab = frames(spark, docs, tables[0][:20], [])
    assert {(r.score, r.predicted) for r in toxicity(df, lab).collect()} == {(0.0, 0)}
    assert drop_toxic(df, lab).count() == 20
    df, lab = frames(spark, docs, [], tables[1])
    assert toxicity(df, lab).count() == 0


def test_search_equals_brute_force():
    rng = np.random.default_rng(1)
    vocabulary = [f"t{i}" for i in range(40)]
    make = lambda: sorted(rng.choice(40, rng.integers(1, 8), replace=False).tolist())
    examples = [(i, int(rng.integers(2)), t := make(), [int(x) for x in rng.integers(1, 5, len(t))]) for i in range(500)]
    m = build_index(vocabulary, rng.random(40) + 0.5, examples)
    order = {k: n for n, k in enumerate(m.keys)}
    dense = np.zeros((500, 40))
    for k, _, t, tf in examples:
        ids, w = m.weigh(t, tf)
        dense[order[k], ids] = w
    for _ in range(60):
        t = make()
        ids, w = m.weigh(t, [1] * len(t))
        want = dense[:, ids] @ w
        top = sorted(((-s, i) for i, s in enumerate(want) if s > 0))[:15]
        got = m.nearest(ids, w, 15)
        assert np.allclose([s for s, _ in got], [-s for s, _ in top])
    assert m.nearest(np.empty(0, np.int64), np.empty(0)) == []


def test_calibration_is_monotone():
    m = build_index([], np.empty(0), [])
    calibrate(m, [(0, 50, 1), (300, 10, 5), (500, 10, 3), (900, 20, 19)], 1000)
    chances = [m.chance(v) for v in np.linspace(0, 1, 50)]
    assert all(a <= b for a, b in zip(chances, chances[1:])) and 0 < chances[0] < 0.1 and chances[-1] > 0.8


def test_terms():
    assert terms_of("stupidity") == ["stupidity", "stup*", "stupi*", "stupid*"]
    assert Terms(["stup*", "x"]).counts("Stupid STUPOR x, y") == ([0, 1], [2, 1])
    assert Terms(["x"]).counts(None) == ([], [])


def test_sampled_labels_keep_the_class_shares(spark, docs, tables):
    from tidemark.llm.toxicity import fit, learning_rows
    rows, labels = tables
    df, lab = frames(spark, docs, rows, labels)
    sample, weight = learning_rows(lab, "doc_id", "toxic", 60)
    free = [y for i, y in labels if zlib.crc32(str(i).encode()) % 3 != 1]
    assert sorted(r["count"] for r in sample.groupBy("y").count().collect()) == [60, 60]
    assert weight == {y: max(1.0, free.count(y) / 60) for y in (0, 1)}
    model, _ = fit(df, lab, max_rows=60)
    low = model.chance(0.0)
    assert low < 0.1 and model.chance(1.0) > 0.7
