"""From raw documents to training tokens, in five stages.

Documents that the quality classifier rejects go, then exact copies, then near copies; what is
left is mixed to the target weights of its sources and encoded. Every stage reads what the one
before it has written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagtide.llm import bpe, exact_dedup, hyperminhash, mixing, quality
from tagtide.llm.common import small_batches, stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts; it learns from the labels of ``sf_dir``."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest original, then the smallest id."""
    small_batches(spark)
    return exact_dedup.exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id."""
    small_batches(spark)
    return hyperminhash.near_dedup(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix; one that is taken in two epochs is there twice."""
    small_batches(spark)
    return mixing.mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, token_ids`` and the digests of the ids and of what they decode to."""
    small_batches(spark)
    path, pattern = bpe.vocabulary()
    return bpe.encode_with_digests(docs.select("doc_id", "lang", "source", "text"), path, pattern).drop("text")


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("source mix", source_mix),
    ("byte-level BPE", tokens),
]

#: The classifier and the tokenizer have no SQL; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs)
    return docs
