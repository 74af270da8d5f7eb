"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.llm import (
    chunk_dedup, decontaminate, line_dedup, mixing, near_dedup, prefix_trie, quality, ranked_search, suffix_dedup, token_scan, toxicity,
    url_filter, warc,
)
from gradeline.llm.common import read

RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, sf_dir)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(read(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(read(spark, sf_dir, "documents"), 85)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.exact_groups(read(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_scan.token_counts(read(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter.apply_rules(read(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(prefix_trie.rebuild(prefix_trie.encode(read(spark, sf_dir, "conversations"))))


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc, op2_mixing, op3_near_dedup, op4_quality, op5_toxicity, op6_substring_dedup,
        op7_decontaminate, op8_exact_dedup, op9_token_counts, op10_url_filter,
        op11_line_dedup, op12_ranked_search, op13_prefix_trie,
    )
}
