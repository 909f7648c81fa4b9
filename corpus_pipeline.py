"""Corpus pipeline over ``documents``: five stages, each one of the training-data operators.

Every stage takes null, empty and very long texts, null and repeated ids,
repeated rows, empty tables and columns of any further names, and all but the
last return the columns they were given.  Documents are judged by their text:
equal texts share their fate, and a null id is kept or dropped like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, secret_scan, sentencepiece_bpe, simhash_neardup, toxicity
from tidemark.llm.common import table
from tidemark.llm.queries import vocabulary_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more for toxicity go.

    Null and empty texts have no neighbours and get the chance of such rows; without labels of both classes nothing
    goes; labels of null id or class count for nothing."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (4-word shingles, 4 differing bits): that of the smallest id.

    Wordless texts, null ones among them, share fingerprint zero and are one group; a group without ids keeps one
    document; of repeated rows one stays."""
    return simhash_neardup.keep_one_per_group(docs, shingle=4, max_distance=4)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go; null, empty and wordless texts and items overlap nothing."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked and ``n_chars`` follows; every document stays, a null text stays null."""
    return secret_scan.redact_secrets(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece counts and digests under merge-dropout, with the round trip checked; null and empty texts have no pieces."""
    pieces = sentencepiece_bpe.Pieces.from_model(vocabulary_path("piece_bpe_32k.model"))
    return sentencepiece_bpe.encode_report(docs, pieces, dropout=0.1, seed=42)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_neardup", near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scans", redact_secrets),
    ("sentencepiece", tokenize),
]

#: The toxicity scores and the SimHash groups have no SQL form; tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
