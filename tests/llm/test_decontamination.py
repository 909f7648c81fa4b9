import itertools
import random

import numpy as np

from tidemark.llm.decontamination import MASKS, contaminated, drop_contaminated, longest_overlap, tokens, whole_masks


def words(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))) for _ in range(n)]


def plain_overlap(equal, share):
    best = (0, 0, 0)
    for a in range(len(equal)):
        for b in range(a, len(equal)):
            part = equal[a:b + 1]
            if equal[a] and equal[b] and sum(part) >= share * len(part) - 1e-9 and len(part) > best[0]:
                best = (len(part), int(sum(part)), a)
    return best


def test_masks_hit_every_stretch_with_substitutions():
    for width, subs in ((13, 2), (15, 3)):
        for places in itertools.combinations(range(width), subs):
            assert any(not {o + p for p in m} & set(places) for m in MASKS for o in range(width - m[-1]))


def test_masks_of_short_items_hit_every_allowed_substitution():
    for n in range(1, 13):
        masks = [(m, o) for m in MASKS for o in range(n - m[-1])] + [(m, 0) for m in whole_masks(n)]
        allowed = int(n * 0.2 + 1e-9)
        for k in range(allowed + 1):
            for places in itertools.combinations(range(1, n - 1), min(k, max(0, n - 2))):
                assert any(not {o + p for p in m} & set(places) for m, o in masks), (n, places)


def test_short_items_are_found_whole(spark, docs):
    items = [(n, " ".join(words(100 + n, n))) for n in range(1, 13)]
    rows = []
    for n, text in items:
        w = text.split()
        for k in range(3):
            for places in itertools.combinations(range(n), k):
                v = [("zz" if i in places else x) for i, x in enumerate(w)]
                rows.append((len(rows), " ".join(["q", *v, "q"])))
    rows.append((len(rows), "The answer is FORTY two."))
    items.append((99, "the answer is forty two"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = contaminated(docs(rows), bench).collect()
    assert sorted((str(r.doc_id), str(r.item_id), r.overlap_tokens) for r in got) == plain(rows, items)
    kept = {r.doc_id for r in drop_contaminated(docs(rows), bench).collect()}
    assert kept == {i for i, _ in rows} - {r.doc_id for r in got}


def test_longest_overlap_equals_plain_form():
    rng = random.Random(4)
    for _ in range(200):
        e = np.array([rng.random() < rng.choice((0.5, 0.8, 0.95)) for _ in range(rng.randint(0, 30))], bool)
        assert longest_overlap(e, 0.8)[:2] == plain_overlap(e.tolist(), 0.8)[:2]


def plain(rows, items, min_tokens=13, share=0.8):
    """Every alignment of every pair, without seeds."""
    out = []
    for i, t in rows:
        d = tokens(t)
        for k, body in items:
            q, best = tokens(body), 0
            for shift in range(-len(q) + 1, len(d)):
                lo, hi = max(0, -shift), min(len(q), len(d) - shift)
                n = plain_overlap([q[x] == d[x + shift] for x in range(lo, hi)], share)[0] if hi > lo else 0
                best = max(best, n if n >= min(min_tokens, len(q)) else 0)
            if best:
                out.append((str(i), str(k), best))
    return sorted(set(out))


def tables(spark, docs):
    a, b, c = words(1, 30), words(2, 20), words(3, 13)
    swapped = list(a)
    for x in (3, 9, 15, 21, 27):
        swapped[x] = "other"
    half = list(a)
    for x in range(0, 30, 2):
        half[x] = "other"
    j = " ".join
    rows = [(1, j(words(5, 20) + a + words(6, 9))), (2, j(words(7, 5) + swapped).upper().replace(" ", ", ")), (3, j(half)),
            (4, None), (5, ""), (6, j(words(8, 60))), (None, j(a)), (7, j(a[:12])), (8, j(a[10:24])), (9, j(b + c)),
            (9, j(b + c)), (10, j(words(9, 40) + b + words(10, 3) + b)), (11, j(c[:7] + ["x"] + c[8:]))]
    items = [(1, j(a)), (2, j(b)), (3, j(c)), (4, "tiny item"), (5, None), (None, j(words(11, 20))), (2, j(b)), (6, "")]
    bench = spark.createDataFrame([(*i, "clash") for i in items], "item_id long, text string, doc_id string")
    return docs(rows), rows, bench, items


def test_pairs_equal_all_alignments(spark, docs):
    df, rows, bench, items = tables(spark, docs)
    want = plain(rows, items)
    for block in (1_000_000, 40):
        got = contaminated(df, bench, block_tokens=block).collect()
        assert sorted((str(r.doc_id), str(r.item_id), r.overlap_tokens) for r in got) == want
    assert {w[0] for w in want} == {"1", "2", "None", "8", "9", "10", "11"}


def test_dropping_keeps_clean_rows_whole(spark, docs):
    df, rows, bench, _ = tables(spark, docs)
    out = drop_contaminated(df, bench)
    assert out.columns == df.columns
    assert sorted(str(r.doc_id) for r in out.select("doc_id").collect()) == ["3", "4", "5", "6", "7"]


def test_empty_tables(spark, docs):
    df, _, bench, _ = tables(spark, docs)
    assert contaminated(docs([]), bench).count() == 0
    assert contaminated(df, bench.limit(0)).count() == 0
    assert drop_contaminated(df, bench.limit(0)).count() == df.count()


def test_very_long_text(spark, docs):
    a = words(1, 30)
    df = docs([(1, " ".join(["and"] * 30_000 + a + ["and"] * 30_000))])
    bench = spark.createDataFrame([(1, " ".join(a)), (2, "and " * 40)], "item_id long, text string")
    got = {r.item_id: r.overlap_tokens for r in contaminated(df, bench).collect()}
    assert got == {1: 30, 2: 40}
