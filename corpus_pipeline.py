"""Corpus pipeline: stages over ``documents``, each reading what the one before
kept. Language identification rejects what is no known language, exact copies
and near copies go, and what is left is packed into sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legwise.llm import exact_dedup, language_id, packing, shingle_join
from legwise.llm.common import cut, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of a known language."""
    return language_id.identify_documents(docs).where("accepted").select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of the documents with equal texts, that with the largest id."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies
    (and any without an id)."""
    found = shingle_join.jaccard_components(docs)
    gone = cut(found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct(), "near-gone")
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their places in sequences of 1024 tokens."""
    return packing.best_fit_packing(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language_id", language), ("exact_dedup", exact), ("ngram_join", near), ("packing", pack)]

#: Language identification and tokenisation are beyond SQL; tests/llm compare
#: the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
