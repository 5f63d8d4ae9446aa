"""Corpus pipeline: quality rules, quality classifier, near duplicates, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsgraph.llm import compress_quality, jaccard, line_rules, packing
from newsgraph.llm.queries import BPE
from newsgraph.llm.shared import read, stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-first rules keep."""
    return line_rules.clean(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted good.  The model is fitted on the labelled rows of
    ``documents`` itself: the rules have already taken the bad ones out of
    ``docs``."""
    return compress_quality.keep_good(docs, read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return jaccard.keep_one(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their place in a sequence."""
    return packing.pack_documents(docs, BPE)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", near_duplicates),
    ("best_fit_packing", best_fit_packing),
]

#: No stage behind the first can be said in SQL; tests/llm holds the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
