"""Training-corpus pipeline over ``documents``: language, toxicity, near
duplicates, personal data, packing.

Each stage gets every document its predecessor kept, as a table read back from
Parquet, and its decisions take effect: the filters drop rows, the masking
stage rewrites texts, the last stage returns packed pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keepwise.llm import language, packing, pii, simhash, toxicity
from keepwise.llm.common import materialise, table
from keepwise.llm.queries import BYTE_BPE, BYTE_BPE_RANKS


def language_identification(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return language.keep_identified(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the rejected severity; learned from the labels of the documents given."""
    return toxicity.keep_civil(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and words that disclose it masked."""
    return pii.sanitise(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents packed into sequences."""
    return packing.pack_documents(docs, BYTE_BPE, BYTE_BPE_RANKS)


STAGES = [
    ("language ID", language_identification),
    ("toxicity", toxicity_filter),
    ("SimHash near-dedup", simhash_near_dedup),
    ("PII", personal_data),
    ("best-fit packing", best_fit_packing),
]
#: The model-based stages cannot be stated in SQL; tests/llm holds each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read back."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialise(stage(spark, docs, sf_dir), f"stage{number}")
    return docs


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
