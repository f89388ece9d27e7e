"""Registered queries of the training-data operators.

Each applies its operator with production parameters to the whole table."""

from __future__ import annotations

from collections.abc import Callable
from zlib import crc32

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (ann, bitslice, bpe, language, licences, packing, periods, pii, simhash, sketch, toxicity, whitening,
               wrappers)
from .common import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), WORD_BPE)


def op2_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op3_language_identification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op4_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_toxicity_grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.grade_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprint_documents(table(spark, sf_dir, "documents"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE, BYTE_BPE_RANKS)


def repeated_tail(doc_id: int | None, words: list) -> list:
    """The words of a document as the query on periodic runs reads them: in one
    document of ten the words from place a on are a stretch of p words repeated.
    Documents without id stay as they are."""
    if doc_id is None or not words:
        return words
    h = crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digest_runs(periods.periodic_runs(table(spark, sf_dir, "documents"), repeated_tail))


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitslice.top_k(table(spark, sf_dir, "embeddings"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_bpe_round_trip, op2_html_main_text, op3_language_identification,
        op4_simhash_near_duplicates, op5_toxicity_grades, op6_licence_scan, op7_nearest_neighbours,
        op8_document_fingerprints, op9_personal_data, op10_best_fit_packing, op11_periodic_runs, op12_exact_top_k,
        op13_embedding_whitening)
}
#: DuckDB twins; the others cannot be stated in SQL, so the tests hold them against brute force.
ORACLE: dict[str, str] = {"op12_exact_top_k": bitslice.TOP_K_SQL}
