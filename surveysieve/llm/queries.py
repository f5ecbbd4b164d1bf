"""One query per operator: (spark, folder of the tables) -> DataFrame, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveysieve.llm import (
    bpe,
    exact_dedup,
    html_text,
    jaccard,
    packing,
    quality,
    simhash,
    suffix_dedup,
    token_counts,
    token_files,
    vector_codes,
    warc,
    whitening,
)
from surveysieve.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def piece_digests(pieces: DataFrame) -> DataFrame:
    """Packed pieces with the checksum of their ids in place of these."""
    digests = F.crc32("ids").alias("ids_crc32")
    return pieces.select(
        "doc_id", "start", "length", digests, "doc_tokens", "sequence_id", "offset", "sequence_length"
    )


@query
def op1_packing(spark, sf_dir):
    """Pieces of all documents, packed into sequences of at most 2048 tokens."""
    return piece_digests(packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


@query
def op2_bpe(spark, sf_dir):
    """Digests of the ids of all documents, and of the texts they decode to."""
    encoded = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), decoded=True)
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op3_quality(spark, sf_dir):
    """Quality scores of all documents, learned from the labels outside the held-out fold."""
    documents = table(spark, sf_dir, "documents")
    return quality.score(documents, quality.train(documents, table(spark, sf_dir, "labels")))


@query
def op4_jaccard_join(spark, sf_dir):
    """Classes of similar documents, and how many each one is similar to."""
    return jaccard.similarity_classes(table(spark, sf_dir, "documents"))


@query
def op5_html_text(spark, sf_dir):
    """Main text of all pages."""
    pages = table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.learn(pages))


@query
def op6_simhash(spark, sf_dir):
    """Fingerprints of all documents and of their edited texts, and how alike they are."""
    return simhash.compare_edited(table(spark, sf_dir, "documents"))


@query
def op7_token_files(spark, sf_dir):
    """Ids of all documents as read back from files of equally long sequences."""
    documents = table(spark, sf_dir, "documents")
    read = token_files.write_and_read(documents, public_tokenizers.path("byte_bpe_50k.json"))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_warc(spark, sf_dir):
    """Records of all pages, converted from legacy archives and read back."""
    return warc.archive_pages(table(spark, sf_dir, "pages"), least_bytes=0)


@query
def op9_exact_dedup(spark, sf_dir):
    """Groups of equal documents, and which of them stay."""
    return exact_dedup.mark_copies(table(spark, sf_dir, "documents"))


@query
def op10_token_counts(spark, sf_dir):
    """Tokens of every line of all documents."""
    return token_counts.count_sections(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query
def op12_vector_codes(spark, sf_dir):
    """Codes of all embeddings, how far they are off, and a digest of the codebooks."""
    codes = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return codes.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", "codebooks_sha256")


@query
def op13_whitening(spark, sf_dir):
    """All embeddings whitened along their first components."""
    rows, about, components, off = whitening.whiten(table(spark, sf_dir, "embeddings"))
    shares = [] if components is None else (components.values / components.trace).tolist()
    explained = F.element_at(F.array(*map(F.lit, shares)).cast("array<double>"), F.col("component"))
    return rows.select(
        "vec_id",
        "component",
        F.lit(about.n if about else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(off).alias("identity_error"),
    )


@query
def op11_suffix_dedup(spark, sf_dir):
    """What is left of all documents without passages of 200 bytes that occur more than once."""
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
