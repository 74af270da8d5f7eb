"""The comparison of signatures inside buckets: blocks, hot components, and work in proportion to the rows."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeline.llm import components, near_dedup
from gradeline.llm.near_dedup import SYMBOLS


def sets_of(text):
    w = text.lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows, percent):
    parent = {i: i for i, _ in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = {i: sets_of(t) for i, t in rows}
    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    return {i: root(i) for i in parent}


def cluttered(rng, n):
    """Texts that share most of a passage: chains of near copies and many pairs just under the limit."""
    passage = [f"p{i}" for i in range(200)]
    rows = []
    for i in range(n):
        own = list(passage)
        for _ in range(rng.choice([0, 1, 2, 4, 5, 6])):
            own[rng.randrange(200)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    return rows


@pytest.mark.parametrize("block,small,texts", [(4096, 24, 512), (7, 3, 5)])
def test_clusters_of_many_components_equal_brute_force(spark, monkeypatch, block, small, texts):
    """Also with more rows in a bucket and in a cluster than a block holds."""
    monkeypatch.setattr(near_dedup, "SIGN_BLOCK", block)
    monkeypatch.setattr(near_dedup, "SMALL_GROUP", small)
    monkeypatch.setattr(near_dedup, "BLOCK", texts)
    rows = cluttered(random.Random(8), 120)
    got = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 85).collect()
    assert {r.doc_id: r.component_id for r in got} == brute(rows, 85)
    assert len(set(brute(rows, 85).values())) > 3


def signed(spark, labels):
    return spark.createDataFrame([(1, i, label, bytes(2 * SYMBOLS)) for i, label in enumerate(labels)], "key long, rep long, label long, signature binary")


def test_every_pair_of_components_meets_in_a_block(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SIGN_BLOCK", 4)
    labels = [0] * 30 + [1, 1, 2, 3, 4, 5]
    met = set()
    for _, g in near_dedup._deal(signed(spark, labels)).toPandas().groupby(["key", "i", "j"]):
        met |= {frozenset((x.rep, y.rep)) for x in g.itertuples() for y in g.itertuples() if (x.block, y.block) == (x.i, x.j)}
    for a, b in combinations(range(len(labels)), 2):
        assert labels[a] == labels[b] or frozenset((a, b)) in met


def test_a_hot_component_is_dealt_in_proportion(spark):
    """One stray row beside a large component, and boilerplate without any link."""
    for labels in ([0] * 9000 + [1], list(range(4000))):
        assert near_dedup._deal(signed(spark, labels)).count() <= 2 * len(labels) + 2
    dealt = []
    for n in (300, 600, 1200):
        rng = random.Random(n)
        shared = " ".join(f"s{i}" for i in range(100))
        rows = [(i, shared + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))) for i in range(n)]
        plan = near_dedup.plan_for(85)
        signs = near_dedup.signatures(spark.createDataFrame(rows, "doc_id long, text string")).withColumnRenamed("doc_id", "rep")
        keys = near_dedup.bucket_keys(signs, plan)
        hot = keys.join(keys.groupBy("key").count().filter("count > 1"), "key").join(signs, "rep")
        dealt.append(near_dedup._deal(hot.select("key", "rep", F.col("rep").alias("label"), "signature")).count() / n)
    assert dealt[2] < 2 * dealt[0] + 1


def test_stars_join_a_list_of_edges():
    assert sorted(components.stars([(5, 3), (3, 9), (7, 8), (9, 2), (4, 4)])) == [(2, 3), (2, 5), (2, 9), (7, 8)]
    assert components.stars([]) == []
    long = [(i, i + 1) for i in range(5000)]
    random.Random(1).shuffle(long)
    assert sorted(components.stars(long)) == [(0, i) for i in range(1, 5001)]


def test_components_of_a_long_path(spark, monkeypatch):
    monkeypatch.setattr(components, "LOCAL_EDGES", 10)
    edges = spark.createDataFrame([(i, i + 1) for i in range(400)] + [(1000, 999), (7, 7), (None, 3)], "a long, b long").repartition(16)
    got = {r.node: r.label for r in components.connected(edges).collect()}
    assert got == {i: 0 for i in range(401)} | {999: 999, 1000: 999}
    assert components.connected(edges.filter("false")).count() == 0


def test_equal_signatures_have_no_distance():
    assert near_dedup.plan_for(85).distance == 23 and not np.any(near_dedup._signatures(np.zeros(0, np.uint64), np.array([0, 0])))
