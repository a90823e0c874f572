"""The documents table made into a token mixture, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from reviewflow.llm import bpe, dedup, mixing, ngram_join, quality
from reviewflow.llm.tables import read, saved

VOCABULARY = "byte_bpe_50k.tiktoken"
# Rows handed to Python at a time. Documents are long: Spark's own 10,000 are some 35 MB, which both sides hold more than once.
ARROW_ROWS = 1000


def _long_texts(spark: SparkSession) -> None:
    """Small Arrow batches, for this session from now on, as stages run when what they return is written."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    _long_texts(spark)
    return quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    _long_texts(spark)
    return dedup.drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar texts."""
    _long_texts(spark)
    return ngram_join.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: a document that is taken twice comes twice."""
    _long_texts(spark)
    return mixing.draw(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count of each entry of the mixture, digests of its ids and of the text decoded from them."""
    _long_texts(spark)
    return bpe.token_digests(docs, str(public_tokenizers.path(VOCABULARY)))


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode_tokens),
]

# Components of similar documents and ranked merges are beyond SQL; tests/llm compares with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; what a stage keeps is written to the shared folder for the next."""
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = saved(docs, f"stage-{number + 1}")
    return docs
