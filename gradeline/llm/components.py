"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gradeline.sources.stage import stage

#: Edges that a task joins to stars at a time.
LOCAL_EDGES = 500_000


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, F.col("u") == F.col("w")).select(F.col("m").alias("a"), F.col("v").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m")).withColumnRenamed("b", "w")
    hung = edges.join(least, F.col("b") == F.col("w"))
    return hung.select(F.col("m").alias("a"), F.col("b")).union(hung.select("m", "a"))


def stars(edges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The components of a list of edges as stars round their smallest nodes."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[p]
        return x

    for a, b in edges:
        p, q = root(a), root(b)
        if p != q:
            parent[max(p, q)] = min(p, q)
    return [(r, x) for x in parent if (r := root(x)) != x]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join what a task reads to stars, a bounded number of edges at a time; edges are not dealt for it."""
    held: list[tuple[int, int]] = []

    def out() -> pa.RecordBatch:
        a, b = zip(*found) if (found := stars(held)) else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    for batch in batches:
        held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        if len(held) >= LOCAL_EDGES:
            yield out()
            held = []
    yield out()


def connected(edges: DataFrame) -> DataFrame:
    """(node, label): for each node with an edge (a, b) the smallest node of its component.

    Each round is a few joins on node ids, written as a table, after which each task joins its own edges to
    stars. The driver sees only a count and a sum of hashes of the edges, which come with the write and stand
    still when every component is a star round its smallest node. Self-edges and null ends are ignored.
    """
    def tidy(table: DataFrame) -> tuple[DataFrame, dict]:
        seen = Observation()
        whole = table.select("a", "b").filter("a < b").mapInArrow(_local, "a long, b long").distinct()
        kept = stage(whole.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")), "edges")
        return kept, seen.get

    now, mark = tidy(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    before = None
    while mark != before and mark["n"]:
        before = mark
        now, mark = tidy(_small_star(_large_star(now)))
    return now.select(F.col("b").alias("node"), F.col("a").alias("label")).union(now.select("a", "a")).distinct()
