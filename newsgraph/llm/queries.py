"""Registered queries of this subpackage: ``QUERIES`` and their DuckDB ``SQL``."""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (chat, compress_quality, importance, jaccard, licenses, line_rules, order_minhash, packing, pieces,
               prefix_trie, repeats, url_filter, wrappers)
from .shared import read

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), BPE)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.op2(read(spark, sf_dir, "pages"))


def op3_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.op3(read(spark, sf_dir, "documents"), PIECES)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.op4(read(spark, sf_dir, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(read(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.op6(read(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.op7(read(spark, sf_dir, "pages"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_quality.op8(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op9(read(spark, sf_dir, "conversations"))


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.op10(read(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.op11(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.op12(read(spark, sf_dir, "conversations"))


def op13_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.op13(read(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_html_extraction": op2_html_extraction,
    "op3_sentencepiece_nbest": op3_sentencepiece_nbest,
    "op4_license_scan": op4_license_scan,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_quality_rules": op6_quality_rules,
    "op7_url_filter": op7_url_filter,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_chat_formatting": op9_chat_formatting,
    "op10_document_fingerprints": op10_document_fingerprints,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_suffix_array_dedup": op13_suffix_array_dedup,
    "pipeline": pipeline,
}

#: Tokenisation, compression, CRC-32 and MinHash are no SQL; tests hold those queries
#: against brute force, round trips and held-out labels.
SQL = {
    "op4_license_scan": licenses.SQL,
    "op6_quality_rules": line_rules.SQL,
    "op9_chat_formatting": chat.SQL,
}
