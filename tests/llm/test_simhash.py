import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tidemark.llm.simhash_neardup import (_cells, fingerprint, keep_one_per_group, simhash_links, simhash_neardup)


def plain_fingerprint(text, n=4):
    import re
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    shingles = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    total = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for k in range(64):
            total[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * total[k] > len(shingles))


def components(fps, limit):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if bin((fps[i] ^ fps[j]) & (2**64 - 1)).count("1") <= limit:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_equals_plain_form(spark):
    texts = [None, "", " \n\t", "one", "One TWO three", "a b c d", "a b c d e É é x\x1cy ſ", "w " * 50_000]
    for t in texts:
        assert fingerprint(t) & (2**64 - 1) == plain_fingerprint(t)
    shingle = spark.sql("select xxhash64('one two three four') h").first().h
    assert xxhash.xxh64_intdigest(b"one two three four", 42) == shingle & (2**64 - 1)


def around(rng, centre, bits):
    for k in rng.sample(range(64), bits):
        centre ^= 1 << k
    return centre


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_all_pairs_within_the_limit_share_a_cell():
    rng = random.Random(3)
    for limit, steps in ((1, 0), (4, 1), (5, 1), (9, 2)):
        for _ in range(60):
            a = rng.getrandbits(64)
            pair = np.array([signed(a), signed(around(rng, a, rng.randint(0, limit)))])
            who, key = _cells(pair, steps)
            assert set(key[who == 0].tolist()) & set(key[who == 1].tolist())


def link_table(spark, fps, limit, block):
    from tidemark.llm.simhash_neardup import simhash_components
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    got = {r.fp: r.root for r in simhash_components(df, limit, block).collect()}
    by_root, want = {}, {}
    for f, r in zip(fps, components(fps, limit)):
        by_root.setdefault(got[signed(f)], set()).add(f)
        want.setdefault(r, set()).add(f)
    return sorted(map(sorted, by_root.values())), sorted(map(sorted, want.values()))


def test_links_equal_brute_force_with_crowded_cells_split(spark):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(20)]
    fps = sorted({around(rng, rng.choice(centres), rng.randint(0, 5)) for _ in range(500)} | {0, 1, 2**64 - 1, 15, 31})
    for limit, block in ((4, 2048), (4, 8), (2, 2048)):
        got, want = link_table(spark, fps, limit, block)
        assert got == want


def test_links_are_a_forest(spark):
    rng = random.Random(6)
    c = rng.getrandbits(64)
    df = spark.createDataFrame([(signed(c ^ (1 << i) ^ (1 << j)),) for i in range(20) for j in range(i)], "fp long")
    # All 17,955 pairs link and share many cells; a group gives a row per member at most, a member visits 50 cells.
    assert 0 < simhash_links(df, 4).count() < 190 * 50


def test_table(spark, docs):
    a = " ".join(f"w{i}" for i in range(400))
    near = a.replace("w7 ", "x7 ")
    rows = [(5, a), (9, a.upper()), (7, near), (1, "clean and quite other text here"), (3, None), (4, ""), (None, a),
            (2, " \n"), (5, a), (None, "alone without an id")]
    got = simhash_neardup(docs(rows)).collect()
    fps = [plain_fingerprint(t) for _, t in rows]
    root = components(fps, 4)
    want = []
    for (i, _), f, r in zip(rows, fps, root):
        ids = [j for (j, _), q in zip(rows, root) if q == r and j is not None]
        want.append((str(i), signed(f), min(ids) if ids else None))
    assert sorted(map(str, want)) == sorted(str((str(r.id), r.fp, r.component_id)) for r in got)
    assert simhash_neardup(docs([])).count() == 0


def test_one_of_a_group_stays_with_all_columns(spark, docs):
    a = " ".join(f"w{i}" for i in range(400))
    rows = [(5, a), (9, a), (5, a), (None, a), (1, "clean and quite other text here"), (None, "alone, no id"), (3, None),
            (4, "")]
    df = docs(rows)
    out = keep_one_per_group(df)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    assert sorted((str(r.doc_id), r.text) for r in out.select("doc_id", F.coalesce("text", F.lit("-")).alias("text"))
                  .collect()) == sorted([("5", a), ("1", rows[4][1]), ("None", "alone, no id"), ("3", "-")])
    assert keep_one_per_group(docs([])).count() == 0
