"""Queries of the training-data operators over the driver tables.

Each returns the full result of one operator on its whole table with
production parameters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, decontamination, embedding_neardup, hard_negatives, license_scan, secret_scan,
               sentencepiece_bpe, simhash_neardup, substring_dedup, token_counts, token_files, toxicity, url_filter)
from .common import table
from .oracles import ORACLE_SQL  # noqa: F401 - part of the registry

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def put(fn):
        QUERIES[name] = fn
        return fn
    return put


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


@query("op1_token_counts")
def op1(spark, d):
    vocabulary = token_counts.Vocabulary.from_json(vocabulary_path("byte_bpe_50k.json"))
    return token_counts.token_counts(table(spark, d, "documents"), vocabulary)


@query("op2_embedding_neardup")
def op2(spark, d):
    return embedding_neardup.embedding_neardup(table(spark, d, "embeddings"), min_cosine=0.93)


@query("op3_secret_scans")
def op3(spark, d):
    return secret_scan.secret_report(table(spark, d, "documents"))


#: Fixed rules of the URL query.
URL_RULES = [url_filter.Rule("allow", "org", "/"), url_filter.Rule("block", "example.org", "/es/"),
             url_filter.Rule("block", "example.org", "/en/1"), url_filter.Rule("allow", "com", "/fr/"),
             url_filter.Rule("block", "com", "/de/")]


@query("op4_url_filters")
def op4(spark, d):
    """Pages are labelled by the ``labels`` row of their id: low quality or toxic is a block."""
    pages = table(spark, d, "pages")
    labels = table(spark, d, "labels").groupBy("doc_id").agg(
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("block"))
    labelled = pages.join(labels, pages.page_id == labels.doc_id).select("url", "block")
    return url_filter.url_filter(pages, URL_RULES, labelled)


@query("op5_simhash_neardup")
def op5(spark, d):
    found = simhash_neardup.simhash_neardup(table(spark, d, "documents"), shingle=4, max_distance=4)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


@query("op6_substring_dedup")
def op6(spark, d):
    return substring_dedup.repeated_passages(table(spark, d, "documents"))


@query("op7_toxicity")
def op7(spark, d):
    return toxicity.toxicity(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op8_sentencepiece")
def op8(spark, d):
    pieces = sentencepiece_bpe.Pieces.from_model(vocabulary_path("piece_bpe_32k.model"))
    return sentencepiece_bpe.encode_report(table(spark, d, "documents"), pieces, dropout=0.1, seed=42)


@query("op9_license_scans")
def op9(spark, d):
    return license_scan.license_scan(table(spark, d, "documents"))


@query("op10_decontamination")
def op10(spark, d):
    return decontamination.contaminated(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query("op11_alignment")
def op11(spark, d):
    return alignment.alignment(table(spark, d, "documents"), vocabulary_path("byte_bpe_50k.json"),
                               vocabulary_path("piece_bpe_32k.model"))


@query("op12_token_files")
def op12(spark, d):
    """The files go to a new folder beside the checkpoints."""
    path = token_files.scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, d, "documents"), path, vocabulary_path("byte_bpe_50k.json"), end_id=0)
    return token_files.token_file_report(spark, path)


@query("op13_hard_negatives")
def op13(spark, d):
    """Anchors are ids divisible by 100; a seventh of the rows change their label first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, d, "embeddings").withColumn("label", label)
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)
