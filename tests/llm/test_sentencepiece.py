import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.sentencepiece_bpe import Encoder, Pieces, decode_texts, encode_report, encode_texts

PATH = str(public_tokenizers.path("piece_bpe_32k.model"))
TEXTS = [None, "", "  a  b \n c\t", " a", "▁x▁ y", "日本語 ½².x \x00 é 👍🏽", "a" * 900, "ab " * 400, "   ", "\n\n  x",
         "<s> </s> <0x41>", "word " * 20_000, "Hello, world! It's 2024."]


@pytest.fixture(scope="module")
def pieces():
    return Pieces.from_model(PATH)


def ids(raw):
    return np.frombuffer(raw, "<i4").tolist()


def test_without_dropout_equals_the_library(pieces):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = [t for t in TEXTS if t is not None and "▁" not in t]
    assert [ids(r) for r in Encoder(pieces).encode(texts)] == library.encode(texts)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80), st.sampled_from([0.0, 0.1, 0.5, 1.0]), st.integers(0, 5))
def test_decodes_losslessly(pieces, text, dropout, seed):
    assert pieces.decode(ids(Encoder(pieces, dropout, seed).encode([text])[0])) == text


def naive(pieces, encoder, word, key):
    """The agenda read plainly: best score, then leftmost; a skipped candidate waits for a new neighbour."""
    from tidemark.llm.sentencepiece_bpe import NONE
    part, skipped = [pieces.number["▁" if c == " " else c] for c in word], set()
    while True:
        found = []
        for i in range(len(part) - 1):
            rank, at = encoder._ranks(np.array([part[i]]), np.array([part[i + 1]]))
            if rank[0] < NONE and i not in skipped:
                found.append((int(rank[0]), i, int(pieces.result[at[0]])))
        if not found:
            return part
        _, i, made = min(found)
        start = sum(int(pieces.chars[min(x, pieces.base)]) for x in part[:i])
        if encoder._skips(np.array([key], np.uint64), np.array([made]), np.array([start]), len(part))[0]:
            skipped.add(i)
            continue
        part[i:i + 2] = [made]
        # The merged piece's pairs are new candidates; later places move by one.
        skipped = {j if j < i else j - 1 for j in skipped if j not in (i - 1, i, i + 1)}


def test_dropout_equals_a_plain_agenda(pieces):
    import xxhash
    encoder = Encoder(pieces, 0.3, 11)
    for word in ["tokenization", " hello", " internationalisation", " a", "thereof", " unbelievable"]:
        for v in range(encoder.variants):
            key = xxhash.xxh64_intdigest(word.encode(), 11 * 31 + v)
            assert ids(encoder._merge([word], v)[0]) == naive(pieces, encoder, word, key)


def test_seeds_vary_and_repeat(pieces):
    text = "internationalisation of tokenizers " * 20
    one, two = (Encoder(pieces, 0.2, s).encode([text])[0] for s in (1, 2))
    assert one != two
    assert one == Encoder(pieces, 0.2, 1).encode(["other text", text])[1]
    assert len(one) > len(Encoder(pieces).encode([text])[0])


def test_tables(spark, docs, pieces):
    rows = list(enumerate(TEXTS)) + [(None, "no id"), (3, " a")]
    got = encode_report(docs(rows), pieces, 0.2, 7).collect()
    assert len(got) == len(rows) and all(r.lossless for r in got)
    back = decode_texts(encode_texts(docs(rows), pieces, 0.2, 7), pieces).collect()
    assert sorted(((r.id is None, r.id or 0), r.text) for r in back) == sorted(
        ((i is None, i or 0), t or "") for i, t in rows)
    assert encode_report(docs([]), pieces).count() == 0


def cuts(raw, word, pieces):
    """Segmentations of the occurrences of ``word`` in an encoded text of that word alone."""
    out, part = [], []
    for i in ids(raw):
        part.append(pieces.raw[i])
        if b"".join(part) == word:
            out.append(tuple(part))
            part = []
    assert not part
    return out


def last(numbers, word, pieces):
    """Segmentation of ``word``, which ends an encoded text."""
    size = next(k for k in range(1, len(numbers) + 1) if b"".join(pieces.raw[i] for i in numbers[-k:]) == word)
    return tuple(numbers[-size:])


def test_every_occurrence_is_varied_on_its_own(pieces):
    word = " unbelievable"
    encoder = Encoder(pieces, 0.1, 3)
    # Repeats inside one text.
    one = cuts(encoder.encode([(word * 3000)[1:]])[0], word.encode(), pieces)
    assert len(one) == 3000 and len(set(one)) > 20
    # One occurrence in each of many texts, at the same place.
    texts = [f"{i}{word}" for i in range(3000)]
    many = {last(ids(r), word.encode(), pieces) for r in encoder.encode(texts)}
    assert len(many) > 10
    # The mix of segmentations is that of independent keys.
    keys = np.random.default_rng(0).integers(0, 2**63, 1000).tolist()
    free = [naive(pieces, encoder, word, k) for k in keys]
    plain = naive(pieces, Encoder(pieces), word, 0)
    share = sum(c == tuple(pieces.raw[i] for i in plain) for c in one) / len(one)
    assert abs(share - sum(f == plain for f in free) / len(free)) < 0.06


def test_occurrences_equal_a_plain_agenda_however_the_work_is_shared(pieces):
    text = "the unbelievable tokenization of the thereof unbelievable the " * 40
    encoder = Encoder(pieces, 0.3, 11)
    words = encoder.words(" " + text)
    want = [i for w, k in zip(words, encoder.keys(text, len(words))) for i in naive(pieces, encoder, w, k)]
    other = "unbelievable the thereof " * 50
    assert ids(encoder.encode([text])[0]) == want
    assert ids(encoder.encode([other, text])[1]) == want  # from branches grown before
    assert ids(Encoder(pieces, 0.3, 11).encode([other, text, text])[2]) == want


def test_one_rule_for_words_of_every_length(pieces):
    """The heap of very long words and the matrix of the others decide alike."""
    rng = np.random.default_rng(6)
    encoder = Encoder(pieces, 0.3, 5)
    for n in (1, 2, 7, 40, 241, 256):
        for letters in ("etaoin", "ab", "internationalé中"):
            word = " " + "".join(rng.choice(list(letters), n))[:255]
            key = int(rng.integers(0, 2**63))
            code, bytes_of = encoder._codes([word])
            heap = encoder._finish(encoder._merge_long([code[c] for c in word], key), bytes_of)
            assert encoder._cut([word], np.array([key], np.uint64))[0] == heap, (n, letters)
