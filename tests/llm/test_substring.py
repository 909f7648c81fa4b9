import random

import numpy as np

from tidemark.llm.substring_dedup import (BORDER_BITS, LONG_RUN, MAX_BYTES, MIN_BYTES, WINDOW, _GEAR, borders, gear_hashes,
                                          remove_repeats, repeated_passages)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(rng.randint(2, 9))) for _ in range(n))


def plain_borders(raw):
    """One byte at a time."""
    h, last, ends = 0, None, []
    for i, b in enumerate(raw):
        h = (h * 2 + int(_GEAR[b])) % 2**16
        at = i + 1
        if h >> (16 - BORDER_BITS) == 0 and WINDOW <= at < len(raw) and raw[at] & 0xC0 != 0x80:
            if last is None or at - last > MIN_BYTES:
                ends.append(at)
            last = at
    out, start = [], 0
    for e in [*ends, len(raw)] if raw else []:
        while e - start > MAX_BYTES:
            start += MAX_BYTES
            while raw[start] & 0xC0 == 0x80:
                start -= 1
            out.append(start)
        out.append(e)
        start = e
    return out


def test_borders_equal_plain_form():
    for raw in (b"", b"a", prose(1, 400).encode(), b"x" * 5000, "é".encode() * 3000, bytes(range(32, 127)) * 30):
        assert borders(raw).tolist() == plain_borders(raw)
        ends = borders(raw)
        assert not len(ends) or np.diff(ends, prepend=0).max() <= MAX_BYTES
    data = np.frombuffer(prose(2, 60).encode(), np.uint8)
    h, want = 0, []
    for b in data:
        h = (h * 2 + int(_GEAR[b])) % 2**16
        want.append(h)
    assert gear_hashes(data).tolist() == want


def test_insertion_moves_only_near_borders():
    text = prose(3, 800).encode()
    moved = text[:1000] + b"inserted words" + text[1000:]
    a = {text[s:e] for s, e in zip([0, *borders(text)[:-1]], borders(text))}
    b = {moved[s:e] for s, e in zip([0, *borders(moved)[:-1]], borders(moved))}
    assert len(a - b) <= 4


def brute(rows, min_words):
    """The definition read plainly on chunks of ``plain_borders``."""
    order = sorted({(i is None, i or 0, i, t) for i, t in rows if t}, key=lambda r: r[:2])
    first, chunks = {}, []
    for none, _, i, t in order:
        raw, start, own = t.encode(), 0, []
        for e in plain_borders(raw):
            own.append((start, e, raw[start:e]))
            start = e
        chunks.append((i, raw, own))
    for i, raw, own in chunks:
        for _, _, c in own:
            first.setdefault(c, i)
    counts = {}
    for i, raw, own in chunks:
        for _, _, c in own:
            counts[c] = counts.get(c, 0) + 1
    found = []
    for i, raw, own in chunks:
        seen, run = set(), None
        for s, e, c in [*own, (-1, -1, None)]:
            repeat = c is not None and counts[c] > 1 and not (first[c] == i and c not in seen)
            seen.add(c)
            if repeat and run and run[1] == s:
                run[1], run[2] = e, min(run[2], first[c])
            else:
                if run:
                    words = [w for w in range(run[0], run[1]) if raw[w] not in b" \t\n\r\v\f"
                             and (w == 0 or raw[w - 1] in b" \t\n\r\v\f")]
                    if len(words) >= min_words or run[1] - run[0] >= LONG_RUN:
                        found.append((str(i), run[0], run[1], len(words), run[2]))
                run = [s, e, first[c]] if repeat else None
    return sorted(found)


PASSAGE = prose(10, 60)
ROWS = [(1, prose(11, 100) + " " + PASSAGE + " " + prose(12, 50)), (2, PASSAGE + " " + prose(13, 40)),
        (7, prose(14, 30) + "\n" + PASSAGE), (3, prose(15, 200)), (4, None), (5, ""), (6, "short text"),
        (9, prose(15, 200)), (8, prose(16, 60) + " " + PASSAGE + " " + prose(17, 60) + " " + PASSAGE),
        (None, prose(18, 50) + PASSAGE), (12, "same " * 20_000)]


def test_passages_equal_brute_force(spark, docs):
    got = repeated_passages(docs(ROWS)).collect()
    assert sorted((str(r.doc_id), r.byte_start, r.byte_end, r.n_words, r.first_doc_id) for r in got) == brute(ROWS, 15)
    hit = {r.doc_id for r in got}
    assert {2, 7, 8, 9, None} <= hit and not {1, 3, 4, 5, 6} & hit
    assert repeated_passages(docs([])).count() == 0


def test_planted_passages_are_found_wherever_they_stand(spark, docs):
    rows = [(i, prose(10_000 + i, 40 + i) + (" " if i % 2 else "\n") + prose(20_000 + i // 4, 55) + " " + prose(30_000 + i, 30))
            for i in range(120)] + [(1000 + i, prose(40_000 + i, 120)) for i in range(60)]
    hit = {r.doc_id for r in repeated_passages(docs(rows)).collect()}
    assert hit == {i for i in range(120) if i % 4}


def test_removal_keeps_one_copy(spark, docs):
    df = docs(ROWS)
    out = remove_repeats(df)
    assert out.columns == df.columns and out.count() == len(ROWS)
    text = {r.doc_id: r.text for r in out.select("doc_id", "text").collect()}
    assert text[1] == ROWS[0][1] and text[3] == ROWS[3][1] and text[9] == "" and text[4] is None
    middle = PASSAGE[80:200]
    assert middle in text[1] and not any(middle in text[i] for i in (2, 7, 8, None))


def test_scripts_without_blanks(spark, docs):
    rng = random.Random(5)
    han = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))
    passage = han(300)
    rows = [(1, han(200) + passage + han(100)), (2, han(150) + passage), (3, han(500)), (4, passage + han(90))]
    got = repeated_passages(docs(rows)).collect()
    assert {r.doc_id for r in got} == {2, 4} and all(r.n_words < 15 for r in got)
    assert sorted((str(r.doc_id), r.byte_start, r.byte_end, r.n_words, r.first_doc_id) for r in got) == brute(rows, 15)
    left = {r.doc_id: r.text for r in remove_repeats(docs(rows)).collect()}
    assert passage in left[1] and left[3] == rows[2][1] and passage[50:250] not in left[2] + left[4]


def test_rows_that_share_an_id_or_have_none_are_cut_each_by_its_own(spark, docs):
    alone, other = prose(50, 120), prose(51, 120)
    rows = [(1, PASSAGE), (2, alone), (2, prose(52, 30) + " " + PASSAGE + " é" * 9), (None, other),
            (None, "ü" * 7 + " " + PASSAGE), (None, None), (2, ""), (7, prose(53, 20) + " " + PASSAGE),
            (7, prose(53, 20) + " " + PASSAGE)]
    out = remove_repeats(docs(rows)).collect()
    texts = sorted((str(r.doc_id), str(r.text)) for r in out)
    assert len(out) == len(rows)
    for key, text in (("2", alone), ("None", other), ("1", PASSAGE), ("2", ""), ("None", "None")):
        assert (key, text) in texts
    cut = [t for k, t in texts if t not in (alone, other, PASSAGE, "", "None")]
    assert len(cut) == 4 and not any(PASSAGE[80:200] in t for t in cut)
    assert len({t for k, t in texts if k == "7"}) == 1


def test_a_digest_of_most_texts_is_split(spark, docs):
    """Spark splits the skewed partition of the digest join (thresholds forced down)."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = repeated_passages(docs([(i, PASSAGE + " " + prose(60_000 + i, 3)) for i in range(3000)]).repartition(8))
        assert df.count() == 2999
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
