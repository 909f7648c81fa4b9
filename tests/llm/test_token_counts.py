import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm.token_counts import Counter, Vocabulary, token_counts

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))
TEXTS = [None, "", "hello world", "It's  a\n\ntest, isn't it? 123½", "<|endoftext|>a<|endoftext|>", "x" * 9000,
         "ab" * 4000, "日本語 العربية ünïcödé 👍🏽", " \t\x1c   end ", "word " * 30_000, "é" * 300]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.from_json(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_equals_the_library(spark, docs, vocabulary, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (2, "hello world")]
    got = token_counts(docs(rows), vocabulary).collect()
    want = sorted((i is None, i or 0, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
                  for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_empty_table(docs, vocabulary):
    out = token_counts(docs([]), vocabulary)
    assert out.count() == 0 and out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_every_character(vocabulary, library):
    counter = Counter(vocabulary)
    for lo in range(0, 0x11000, 128):
        s = "".join(f"a{chr(x)}1 {chr(x)}{chr(x)}  {chr(x)}b " for x in range(lo, lo + 128) if not 0xD800 <= x < 0xE000)
        assert not s or counter.counts([s])[0] == len(library.encode(s, add_special_tokens=False).ids), hex(lo)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=200))
def test_any_text(vocabulary, library, text):
    assert Counter(vocabulary).counts([text])[0] == len(library.encode(text, add_special_tokens=False).ids)


def test_only_proven_strings_take_the_shortcut():
    # "abc" is a vocabulary string, but the merges of its bytes end at "ab" + "c".
    v = Vocabulary([(b"a", b"b")], [b"a", b"ab", b"abc"], [])
    assert v.whole == {b"a", b"ab"}
    assert Counter(v).counts(["abc"]) == [2]


def test_long_and_short_words_agree(vocabulary):
    for w in (b"abcabcabcab" * 4, bytes(range(97, 123)), b"aaaaaaaaaaaaaaaab"):
        assert vocabulary.merged_lengths([w]) == [vocabulary._merged_length_long(w)]
