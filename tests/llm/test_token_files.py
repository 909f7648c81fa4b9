import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests.llm.conftest import LONG
from tidemark.llm import token_files as T
from tidemark.llm.queries import QUERIES, vocabulary_path
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
FILE = vocabulary_path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 40), max_size=900))
def test_elias_fano_round_trip(values):
    values = np.array(sorted(values), np.uint64)
    ef = T.EliasFano.encode(values)
    back = T.EliasFano.read(memoryview(ef.tobytes()), ef.n, ef.low_bits, ef.high_bits)
    assert back.values().tolist() == values.tolist()
    for i in range(0, len(values), 37):
        assert back.select(i) == values[i]
    with pytest.raises(IndexError):
        back.select(len(values))


def test_elias_fano_space():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    bits = 8 * len(T.EliasFano.encode(values).tobytes()) / len(values)
    assert bits < 2.2 + np.log2(values[-1] / len(values)) + 32 / T.SAMPLE


def test_encoder_equals_library():
    """Every character below U+0250 beside others, special strings, other scripts, no word remembered twice wrongly."""
    with open(FILE, "rb") as f:
        encoder = T.Encoder(f.read(), "<u2")
    assert encoder.words is not None
    tokenizer = Tokenizer.from_file(FILE)
    texts = ["", " ", "it's I'LL we've\n\n  x", "a<|endoftext|>b", "中文 café — “x”"]
    for c in map(chr, range(0x250)):
        texts += [c, f"a{c}b", f" {c}{c} 1{c}", f"{c}'s {c}\t", f"x {c} {c}"]
    rng = np.random.default_rng(2)
    texts += ["".join(map(chr, rng.integers(0, 0x250, 40))) for _ in range(3000)]
    texts += ["".join(rng.choice(list("ab 1\n'st.\u00a0é"), 30)) for _ in range(3000)]
    for t in texts:
        assert np.frombuffer(encoder.encode(t), "<u2").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_other_file_kinds_go_through_the_library():
    file = vocabulary_path("word_bpe_49k.json")
    with open(file, "rb") as f:
        encoder = T.Encoder(f.read(), "<u4")
    want = Tokenizer.from_file(file).encode("Hello, world x", add_special_tokens=False).ids
    assert encoder.words is None and np.frombuffer(encoder.encode("Hello, world x"), "<u4").tolist() == want


def plain(rows):
    """Documents in order with their ids, encoded one by one with the library."""
    tokenizer = Tokenizer.from_file(FILE)
    out, start = [], 0
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_table_equals_plain_encoding(spark):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = sorted(tuple(r) for r in QUERIES["op12_token_files"](spark, SF).collect())
    assert got == plain(docs)


def test_cases(spark, docs, tmp_path):
    """Null and repeated ids and rows, null, empty and long texts, special strings, many shards."""
    rows = [(7, "seven <|endoftext|> up"), (None, "nobody"), (3, None), (3, ""), (-2**63, "least"), (2**63 - 1, "most"),
            (5, LONG), (9, "same"), (9, "same"), (9, "other"), (None, None), (0, "中文 café \U0001f600")]
    path = str(tmp_path / "out")
    T.write_token_files(docs(rows), path, FILE, shard_ids=4)
    got = [tuple(r) for r in T.token_file_report(spark, path).orderBy("start").collect()]
    assert [g[0] for g in got] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k or 0))
    assert sorted(g[2:] for g in got) == sorted(p[2:] for p in plain(rows))
    starts = np.cumsum([0] + [g[2] for g in got])
    assert [g[1] for g in got] == starts[:-1].tolist()
    assert T._shards(spark, path).count() > 5

    tokenizer = Tokenizer.from_file(FILE)
    texts = {}
    for r in T.read_token_files(spark, path).collect():
        assert r.ids[-1] == 0
        texts.setdefault(r.doc_id, []).append(tokenizer.decode(r.ids[:-1], skip_special_tokens=False))
    want = {}
    for k, t in rows:
        want.setdefault(k, []).append(t or "")
    assert {k: sorted(v) for k, v in texts.items()} == {k: sorted(v) for k, v in want.items()}


def test_one_encoder_a_worker(spark, docs, tmp_path, monkeypatch):
    """A Python worker makes its encoder once, whatever the number of its tasks, and the ids stay right."""
    log = str(tmp_path / "made")

    class Noted(T.Encoder):
        def __init__(self, *args):
            super().__init__(*args)
            import os
            with open(log, "a") as f:
                f.write(f"{os.getpid()}\n")

    rows = [(i, f"text number {i} of {i % 7} caf\u00e9") for i in range(600)]
    monkeypatch.setattr(T, "Encoder", Noted)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        T.write_token_files(docs(rows), str(tmp_path / "out"), FILE)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    with open(log) as f:
        made = f.read().split()
    assert made and len(made) == len(set(made))
    got = sorted(tuple(r) for r in T.token_file_report(spark, str(tmp_path / "out")).collect())
    assert got == plain(rows)
    assert T._shards(spark, str(tmp_path / "out")).count() > len(made)


def test_random_access_and_damage(spark, docs, tmp_path):
    path = str(tmp_path / "out")
    T.write_token_files(docs([(i, f"text number {i}") for i in range(600)]).coalesce(1), path, FILE)
    tokenizer = Tokenizer.from_file(FILE)
    for r in T._shards(spark, path).collect():
        shard = T.Shard(bytes(r.content))
        for i in range(0, shard.n, 17):
            assert tokenizer.decode(shard.ids(i)[:-1].tolist()) == f"text number {shard.doc_id(i)}"
        with pytest.raises(ValueError):
            T.Shard(bytes(r.content)[:-2] + b"\n")


def test_empty_table_and_other_ids(spark, docs, tmp_path):
    path = str(tmp_path / "none")
    T.write_token_files(docs([(1, "x")]).where("false"), path, FILE)
    assert T.token_file_report(spark, path).collect() == []
    with pytest.raises(ValueError):
        T.write_token_files(docs([(1, "x")]).withColumn("doc_id", F.lit("a")), str(tmp_path / "bad"), FILE)
