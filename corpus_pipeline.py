"""Prepare a training corpus: five stages, each one operator on all that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gradeline.llm import chunk_dedup, decontaminate, mixing, near_dedup, quality
from gradeline.llm.common import read
from gradeline.sources.stage import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranker rejects go."""
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return chunk_dedup.drop_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, linked at a similarity of 0.8 or more, the document with the smallest doc_id stays."""
    return near_dedup.drop_near_copies(docs, 80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, and how many words of each: the last stage returns these columns."""
    return mixing.taken_words(docs).filter("taken > 0")


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination),
    ("mixing", mixture),
]

#: The quality stage fits a model, which SQL cannot express; tests/llm/test_pipeline.py compares each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
