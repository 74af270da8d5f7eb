"""Nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from gradeline.operators import knn


def frames(spark, q, t, labels):
    qd = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "qid long, features array<double>")
    td = spark.createDataFrame(
        [(i, int(y), v.tolist()) for i, (v, y) in enumerate(zip(t, labels))],
        "tid long, y int, features array<double>",
    )
    return qd.repartition(3), td.repartition(4)


def brute(q, t, k):
    d = ((q[:, None, :] - t[None, :, :]) ** 2).sum(axis=2)
    return [[int(j) for j in np.lexsort((np.arange(len(t)), row))[:k]] for row in d]


@pytest.mark.parametrize("limits", [
    {}, {"max_pivots": 1}, {"max_pivots": 7, "block_rows": 9, "query_rows": 6},
])
@pytest.mark.parametrize("kind", ["clusters", "copies", "few"])
def test_neighbours_equal_brute_force(spark, kind, limits):
    rng = np.random.default_rng(4)
    if kind == "clusters":  # far apart, so most cells are skipped
        centers = rng.normal(size=(6, 3)) * 50
        t = centers[rng.integers(0, 6, 160)] + rng.normal(size=(160, 3))
        q = centers[rng.integers(0, 6, 40)] + rng.normal(size=(40, 3))
    elif kind == "copies":  # a third of the rows are one point
        t = np.round(rng.normal(size=(120, 2)), 1)
        t[:40] = 0.5
        q = np.vstack([t[::9], [[0.5, 0.5]]])
    else:  # fewer training rows than neighbours
        t, q = rng.normal(size=(3, 2)), rng.normal(size=(5, 2))
    labels = rng.integers(0, 3, len(t))
    qd, td = frames(spark, q, t, labels)
    rows = knn.nearest_neighbours(qd, td, "qid", "tid", "y", k=5, **limits).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r["qid"], r["rank"])):
        got.setdefault(r["qid"], []).append(r["tid"])
    want = brute(q, t, 5)
    assert [got[i] for i in range(len(q))] == want
    votes = {r["qid"]: r["prediction"] for r in knn.knn_classify(qd, td, "qid", "tid", "y", **limits).collect()}
    for i, near in enumerate(want):
        tally = np.bincount(labels[near], minlength=3)
        assert votes[i] == int(tally.argmax())  # the smaller label wins a tie


def test_far_cells_are_not_visited(spark):
    rng = np.random.default_rng(9)
    t = np.vstack([rng.normal(size=(60, 2)) + c for c in ((0, 0), (500, 0), (0, 500))])
    d = np.sqrt(knn._distances(t[:1], t[[0, 60, 120]]))
    assert d.argmin() == 0
    qd, td = frames(spark, t[:10] + 0.01, t, np.zeros(180))
    got = knn.nearest_neighbours(qd, td, "qid", "tid", "y").collect()
    assert len(got) == 50 and all(r["tid"] < 60 for r in got)


def blocks_of(t, k=5, block_rows=500):
    vectors = pa.array(t.tolist(), pa.list_(pa.float64()))
    rows = pa.table({"_train": pa.array(range(len(t))), "_label": pa.array([0] * len(t)), "_there": vectors})
    return list(knn._block_rows(rows, k, block_rows))


def searched(q, blocks, k=5):
    """Neighbours of each query row in order, and the blocks that were read."""
    read, got = [], [[] for _ in q]
    lo, hi = (np.array([f(b["vector"].combine_chunks().flatten().to_numpy().reshape(b.num_rows, -1), axis=0) for b in blocks])
              for f in (np.min, np.max))
    load = lambda b: read.append(b) or knn._Block(blocks[b])
    for i, train, _, d in knn._nearest(q, lo, hi, load, k):
        for row in zip(i, d, train.to_pylist()):
            got[row[0]].append(row[1:])
    return [[t for _, t in sorted(g)[:k]] for g in got], read


def test_query_rows_are_not_copied_for_the_cells_they_may_need(spark):
    rng = np.random.default_rng(3)
    t, q = rng.normal(size=(400, 16)), rng.normal(size=(50, 16))
    qd, td = frames(spark, q, t, np.zeros(400))
    near = knn.nearest_neighbours(qd, td, "qid", "tid", "y", block_rows=40)
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "CoGroup" not in plan
    got = {(r["qid"], r["rank"]): r["tid"] for r in near.collect()}
    assert got == {(i, n + 1): j for i, row in enumerate(brute(q, t, 5)) for n, j in enumerate(row)}


def test_few_pairs_are_compared_in_full(monkeypatch):
    full, exact, all_pairs = [], knn._pair_distances, knn._distances
    monkeypatch.setattr(knn, "_pair_distances", lambda a, i, b, j: full.append(len(i)) or exact(a, i, b, j))
    monkeypatch.setattr(knn, "_distances", lambda a, b: full.append(len(a) * len(b)) or all_pairs(a, b))
    rng = np.random.default_rng(5)
    t, q = rng.normal(size=(4000, 48)), rng.normal(size=(300, 48))  # boxes exclude nothing
    got, read = searched(q, blocks_of(t))
    assert got == brute(q, t, 5) and len(read) == len(set(read)) == 8
    assert sum(full) < 0.03 * len(q) * len(t)
    t, q = rng.normal(size=(4000, 2)), rng.normal(size=(100, 2)) * 0.01 + 1.5  # most boxes are far
    got, read = searched(q, blocks_of(t))
    assert got == brute(q, t, 5) and len(read) <= 3


@pytest.mark.parametrize("shift, scale", [(0, 1), (1e6, 1), (-3e8, 1e-3), (0, 1e-170), (0, 1e160)])
def test_products_exclude_no_neighbour(shift, scale):
    rng = np.random.default_rng(8)
    t = np.vstack([rng.normal(size=(900, 7)), rng.integers(0, 2, size=(300, 7))]) * scale + shift
    t = np.vstack([t, t[:200]])  # ties between blocks
    q = np.vstack([t[::60], rng.normal(size=(60, 7)) * scale + shift])
    with np.errstate(over="ignore"):
        got, _ = searched(q, blocks_of(t, block_rows=90))
        d = knn._distances(q, t)
    for row, near in zip(d, got):
        assert near == [int(j) for j in np.lexsort((np.arange(len(t)), row))[:5]]


def test_many_copies_leave_k_rows_of_each():
    t = np.vstack([np.ones((700, 3)), np.zeros((2, 3)), np.full((1, 3), np.nan)])
    blocks = blocks_of(t)
    assert sum(b.num_rows for b in blocks) == 7
    assert searched(np.array([[1.0, 1, 1], [0, 0, 0]]), blocks)[0] == [[0, 1, 2, 3, 4], [700, 701, 0, 1, 2]]


def test_ids_and_labels_keep_their_kinds(spark):
    rows = [(f"{i:03}" if i else None, float(i // 2), i % 3 if i != 4 else None) for i in range(40)]
    td = spark.createDataFrame([(a, [x, 0.0], y) for a, x, y in rows], "tid string, features array<double>, y int")
    qd = spark.createDataFrame([(None, [0.0, 0.0]), ("q", [5.0, 0.0]), ("none", [float("nan"), 0.0])], "qid string, features array<double>")
    near = knn.nearest_neighbours(qd, td, "qid", "tid", "y", k=3, block_rows=4, max_pivots=4).orderBy("qid", "rank").collect()
    assert [(r["qid"], r["tid"], r["label"]) for r in near] == [
        (None, None, 0), (None, "001", 1), (None, "002", 2), ("q", "010", 1), ("q", "011", 2), ("q", "008", 2),
    ]
    with pytest.raises(Exception, match="vectors must be present"):
        knn.nearest_neighbours(qd, td.unionByName(td.limit(1).selectExpr("tid", "cast(null as array<double>) AS features", "y")), "qid", "tid", "y").collect()
