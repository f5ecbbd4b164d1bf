"""From raw documents to packed sequences: quality, exact copies, near copies, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from surveysieve.llm import exact_dedup, jaccard, packing, quality
from surveysieve.llm.common import table
from surveysieve.llm.queries import piece_digests
from surveysieve.sources.sinks import stage_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from labelled ones outside the held-out fold."""
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts."""
    return jaccard.drop_similar(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, in sequences of at most 2048 tokens."""
    return piece_digests(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("packing", pack_sequences),
]

# Trees, sampled paths and tokens are beyond SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table, each one's result written before the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stage_table(docs, f"pipeline-{number}")
    return docs
