import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import LONG
from tidemark.llm import alignment as A
from tidemark.llm.queries import QUERIES, vocabulary_path
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
FILES = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")


def plain(rows):
    """Straight from the definition, token by token."""
    a_tok = Tokenizer.from_file(FILES[0])
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    letters = {c: i for i, c in enumerate(A.byte_alphabet())}
    docs = []
    for key, text in rows:
        a, b = [], []
        if text:
            a = [(i, bytes(letters[c] for c in a_tok.id_to_token(i)))
                 for i in a_tok.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode())
                 for i, p in ((i, b_tok.id_to_piece(i)) for i in b_tok.encode(text))]
            raw = (" " + text).encode()
            if b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw:
                a, b = [], []
        ends = []
        for tokens in (a, b):
            at, now = 0, {}
            for i, t in tokens:
                at += len(t)
                now[at] = i
            ends.append(now)
        both = sorted(set(ends[0]) & set(ends[1]))
        groups, low = [], 0
        for e in both:
            groups.append("|".join(",".join(str(i) for at, i in now.items() if low < at <= e) for now in ends)
                          if len(a) + len(b) < 3000 else None)
            low = e
        docs.append((key, a, b, [(ends[0][e], ends[1][e]) for e in both], groups))
    count = Counter(x for d in docs for x in d[3])
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(key, len(a), len(b), len(links), len(links), sum(count[x] == best[x[1]] for x in links),
             sum(count[x] for x in links),
             None if None in groups else hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
            for key, a, b, links, groups in docs]


def same(got, want):
    key = lambda r: tuple((x is not None, x) for x in r[:7])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:7] for g in got] == [w[:7] for w in want]
    assert all(w[7] in (None, g[7]) for g, w in zip(got, want))


def test_whole_table_equals_plain(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    same(QUERIES["op11_alignment"](spark, SF).collect(), plain(rows))


CASES = [(1, "plain words, plain words"), (2, None), (3, ""), (4, " "), (None, "no id"), (None, None), (5, "same"), (5, "same"),
         (5, "other"), (6, LONG), (7, "中文 café \U0001f600 naïve"), (8, "<|endoftext|> <s> </s> <0x41>"), (9, "▁low line"),
         (10, "tabs\tand\n\nlines  and   spaces"), (11, "x" * 3000), (12, "supercalifragilistic " * 300), (13, "\x00\x01")]


@pytest.mark.parametrize("piece", [1, 2, 7, 500, A.PIECE])
def test_pieces_of_any_size_give_the_same(spark, docs, piece):
    rows = CASES if piece >= 500 else [(k, t[:2000] if t else t) for k, t in CASES]
    same(A.alignment(docs(rows), *FILES, piece=piece).collect(), plain(rows))


def test_counts_joined_by_key_give_the_same(spark, docs):
    rows = CASES + [(100 + i, "the same words again") for i in range(300)]
    for piece in (50, A.PIECE):
        same(A.alignment(docs(rows), *FILES, piece=piece, sent_pairs=0).collect(), plain(rows))


def test_pair_counts(spark, docs, monkeypatch):
    monkeypatch.setattr(A, "HELD", 20)
    found = A.Alignment(docs(CASES), *FILES, piece=300)
    total = sum(r.n for r in found.pairs().collect())
    assert total == sum(r.n_links for r in found.documents().collect())
    assert found.pairs().select("a", "b").distinct().count() == found.pairs().count()


ends = st.lists(st.integers(1, 12), min_size=0, max_size=60).map(lambda x: np.cumsum(np.array(x, np.int64)))


@settings(max_examples=200, deadline=None)
@given(ends, ends, st.integers(1, 30))
def test_merge_path(a, b, piece):
    """Pieces follow one another, are equally long and split the merge of both runs."""
    merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
    places = A.cuts(a, b, piece)
    for n, ((i, j), (k, m)) in enumerate(zip(places, places[1:])):
        assert (k - i) + (m - j) == min(piece, len(merged) - n * piece)
        part = merged[n * piece:(n + 1) * piece]
        assert a[i:k].tolist() == [x for x, s in part if not s] and b[j:m].tolist() == [x for x, s in part if s]
    p, q = A.common(a, b)
    assert a[p].tolist() == b[q].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 70_000), st.integers(0, 70_000)), max_size=50))
def test_packed_links(links):
    a, b = (np.array([x[i] for x in links], np.int64) for i in range(2))
    pair, times = A.unpack_links(A.pack_links(a, b))
    assert Counter(dict(zip(zip((pair >> 32).tolist(), (pair & 0xFFFFFFFF).tolist()), times.tolist()))) == Counter(links)


def test_empty(spark, docs):
    assert A.alignment(docs([(1, "x")]).where("false"), *FILES).collect() == []
    assert [tuple(r) for r in A.alignment(docs([(1, None)]), *FILES).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]
