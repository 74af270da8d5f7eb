"""Balancing and splits: exact sizes, repeatability, copies of one key."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gradeline.operators import sampling


def labelled(spark, sizes):
    rows = [(f"{c}-{i}", c) for c, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "key string, q int").repartition(5)


def counts(df):
    return {r["q"]: r["count"] for r in df.groupBy("q").count().collect()}


@pytest.mark.parametrize("sizes,want", [
    ({0: 20, 1: 300}, {0: 20, 1: int(20 * (1 - 0.4) / 0.4)}),
    ({0: 40, 1: 50}, {0: 40, 1: 50}),  # balanced already
    ({1: 10}, {1: 10}),  # one class
    ({0: 5, 1: 50, 2: 20}, {0: 5, 1: 7}),  # only the largest and the smallest stay
    ({0: 20, 1: 21, 2: 22, 3: 23}, {3: 23, 0: int(23 * 0.4 / (1 - 0.4))}),  # repeated instead
])
def test_balance_sizes(spark, sizes, want):
    df = labelled(spark, sizes)
    got = sampling.balance_classes(df, "q", ["key"])
    assert counts(got) == want
    small = min(want.values())
    if len(want) == 2:
        assert small / sum(want.values()) >= 0.39


def test_same_seed_same_rows_whatever_the_partitioning(spark):
    df = labelled(spark, {0: 30, 1: 400})
    one = sampling.balance_classes(df, "q", ["key"])
    two = sampling.balance_classes(df.repartition(3, "key"), "q", ["key"])
    other = sampling.balance_classes(df, "q", ["key"], seed=7)
    keys = [sorted(r["key"] for r in d.collect()) for d in (one, two, other)]
    assert keys[0] == keys[1] != keys[2]
    assert len(set(keys[0])) == len(keys[0])


def test_repeated_rows_come_from_the_smallest_class(spark):
    df = labelled(spark, {0: 30, 1: 31, 2: 32, 3: 90})
    drawn = sampling.draw_with_replacement(df.where("q = 0"), 30, 3000, ["key"], 1)
    hits = [r["count"] for r in drawn.groupBy("key").count().collect()]
    assert sum(hits) == 3000 and len(hits) == 30 and 60 < min(hits) and max(hits) < 150


@pytest.mark.parametrize("sizes,test_size", [({0: 33, 1: 70}, 0.3), ({0: 7, 1: 11, 2: 13}, 0.25)])
def test_split_sizes(spark, sizes, test_size):
    df = sampling.stratified_split(labelled(spark, sizes), "q", ["key"], test_size)
    got = counts(df.where("is_test"))
    assert got == sampling.test_sizes(sizes, test_size)
    assert sum(got.values()) == -(-int(sum(sizes.values()) * test_size * 1000) // 1000)
    for c, n in sizes.items():
        assert abs(got[c] - n * test_size) <= 1


def test_copies_of_one_key_are_split_to_the_row(spark):
    rows = [("same", 0)] * 101 + [("same", 1)] * 10 + [(str(i), 1) for i in range(40)]
    df = spark.createDataFrame(rows, "key string, q int").repartition(6)
    split = sampling.stratified_split(df, "q", ["key"], 0.5)
    assert split.count() == 151 and counts(split.where("is_test")) == sampling.test_sizes({0: 101, 1: 50}, 0.5)
    assert split.where(F.col("is_test").isNull()).count() == 0
