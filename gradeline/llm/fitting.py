"""Bounded, reproducible samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def class_counts(labels: DataFrame, label: str) -> dict[int, int]:
    """Rows of each class, 0 and 1; other values and nulls are not labels."""
    rows = labels.filter(F.col(label).isin(0, 1)).groupBy(label).count().collect()
    return {int(r[0]): r[1] for r in rows}


def sample_ids(labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """doc_id and y of at most ``per_class`` distinct labelled ids of each class, picked by a digest of the id.

    Each class is picked by a top-k, which keeps ``per_class`` rows per task.
    """
    parts = []
    for y in (0, 1):
        own = labels.filter((F.col(label) == y) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
        parts.append(own.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(per_class).withColumn("y", F.lit(y)))
    return parts[0].union(parts[1])
