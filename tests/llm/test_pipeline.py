import hashlib

import __spark_entry__ as E
import corpus_pipeline as P
from tidemark.llm.decontamination import Index
from tidemark.llm.queries import QUERIES, vocabulary_path
from tidemark.llm.sentencepiece_bpe import Encoder, Pieces
from tidemark.llm.simhash_neardup import fingerprint

SF = "/root/testdata/sf0.001"


def test_registered():
    names = set(E.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert set(E.oracle_sql()) <= names
    assert [n for n, _ in P.STAGES] == ["toxicity", "simhash_neardup", "decontamination", "secret_scans", "sentencepiece"]


def test_every_query_runs(spark):
    for name, fn in QUERIES.items():
        assert E.queries()[name](spark, SF).count() >= 0, name


def test_pipeline_equals_brute_force(spark):
    """Stage by stage over the whole table, with the decisions taken plainly."""
    from tests.llm.test_secret_scan import spans
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scored = QUERIES["op7_toxicity"](spark, SF).collect()
    rows = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id for r in scored if r.predicted}
    left = {i: t for i, t in sorted(rows.items()) if i not in toxic}

    prints = {i: fingerprint(t) & (2**64 - 1) for i, t in left.items()}
    root = {i: i for i in left}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(left)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    left = {i: t for i, t in left.items() if find(i) == i}

    index = Index([(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    left = {i: t for i, t in left.items() if not index.overlaps(t, 13, 0.8)}

    def redacted(t):
        out, at = "", 0
        for s, _, e in sorted(sum(spans(t), [])):
            if s >= at:
                out += t[at:s] + "[SECRET]"
            at = max(at, e)
        return out + t[at:]
    left = {i: redacted(t) for i, t in left.items()}
    encoder = Encoder(Pieces.from_model(vocabulary_path("piece_bpe_32k.model")), 0.1, 42)
    want = {i: (len(t), hashlib.sha256(encoder.encode([t])[0]).hexdigest(), True) for i, t in left.items()}

    frame = docs
    for k, (name, stage) in enumerate(P.STAGES):
        frame = stage(spark, frame, SF)
        if k < len(P.STAGES) - 1:
            assert frame.dtypes == docs.dtypes, name
    assert {r.doc_id: (r.n_chars, r.ids_sha256, r.lossless) for r in frame.collect()} == want
    assert P.run(spark, SF).count() == len(want)
    assert 0 < len(want) < len(rows)


def _tables(spark, folder, documents, labels, benchmark):
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(documents, "doc_id long, text string, lang string, source string").withColumn(
        "n_chars", F.length("text").cast("long"))
    for c in ("row", "key", "id", "h", "fp", "cuts", "score", "label", "base", "_text"):
        docs = docs.withColumn(c, F.lit("clash"))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


def test_edge_cases_through_the_whole_run(spark, tmp_path):
    prose = lambda n, seed: " ".join(f"w{(i * 7919 + seed * 31) % 9973}" for i in range(n))
    item = prose(20, 900)
    rows = [(1, prose(60, 1)), (2, prose(60, 1)), (3, None), (4, ""), (None, prose(50, 2)), (None, None), (5, "word " * 200_000),
            (6, "x" * 500_000), (7, prose(30, 3) + " password=hunter22 " + prose(20, 4)), (8, prose(30, 5) + " " + item),
            (9, prose(70, 6)), (9, prose(70, 6)), (9, prose(70, 7)), (10, " \n\t "), (11, "短い文章です")]
    documents = [(i, t, "en", None) for i, t in rows]
    labels = [(1, 1, 0), (7, 1, None), (None, 1, 1), (9, 0, 1), (9, 0, 0)]
    docs = _tables(spark, str(tmp_path), documents, labels, [(1, item), (2, None), (None, ""), (1, item)])
    out = P.run(spark, str(tmp_path)).collect()
    assert all(r.lossless for r in out)
    kept = sorted(str(r.doc_id) for r in out)
    # Copies and repeated rows leave one, wordless texts are one group, the contaminated document is gone.
    assert kept.count("1") == 1 and "2" not in kept and "8" not in kept
    assert kept.count("9") == 2 and kept.count("7") == 1 and {"5", "6", "11"} <= set(kept)
    assert sum(k in kept for k in ("3", "4", "10")) == 1
    # All stages but the last return the columns of documents.
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
    masked = {r.doc_id: r for r in now.where("doc_id = 7").collect()}[7]
    assert "hunter22" not in masked.text and masked.n_chars == len(masked.text) and masked.row == "clash"


def test_empty_tables_through_the_whole_run(spark, tmp_path):
    _tables(spark, str(tmp_path), [], [], [])
    assert P.run(spark, str(tmp_path)).collect() == []
