"""A corpus pipeline over `documents`: every stage's rows are written as Parquet and reread by the next.

Junk goes first, then exact and near copies; what is left is mixed to the sources'
target weights, in training order and with repeats, and tokenised.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact, jaccard, mixing, pieces, quality
from millrace.llm.queries import QUALITY_FROM, fold
from millrace.sources.tables import settle

NEAR_WORDS, NEAR_PERCENT = 5, 80


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of all folds but the held-out one."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(fold() != 0)
    return quality.keep_good(docs, quality.fit(docs, labels), QUALITY_FROM)


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact.drop_exact_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their word shingles the one with the smallest id stays."""
    return jaccard.drop_similar(docs, NEAR_WORDS, NEAR_PERCENT)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return mixing.curriculum(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and the text that they decode to."""
    return pieces.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), ("doc_id", "lang", "source"))


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", without_exact_copies),
    ("n-gram Jaccard join", without_near_copies),
    ("mixing sources to target weights", mixed),
    ("SentencePiece encoding and decoding", tokenised),
]

# The classifier, the tokenizer and the order of the mix are not SQL: tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = settle(docs, "stage-" + "".join(c if c.isalnum() else "-" for c in name))
    return docs
