"""What the quality model is fitted on, and what its threshold counts."""

from __future__ import annotations

import random

import numpy as np
import pytest

from gradeline.llm import quality
from tests.llm.test_operators import labelled


def usable_rows(spark, docs, labels):
    known = labels.filter(quality.fold(labels.doc_id, quality.FOLDS) != 0).filter("quality in (0, 1)").distinct()
    rows = docs.join(known, "doc_id").collect()
    return np.stack([quality.features(r.text) for r in rows]).astype(float), np.array([r.quality for r in rows])


def test_weights_minimise_the_loss_on_all_pairs(spark):
    docs, labels = labelled(spark, random.Random(21), "quality")
    noisy = labels.selectExpr("doc_id", "case when doc_id % 7 = 3 then 1 - quality else quality end as quality")
    model = quality.train(docs, noisy)
    x, y = usable_rows(spark, docs, noisy)
    assert np.allclose(model.mean, x.mean(axis=0), atol=1e-6) and np.allclose(model.scale, x.std(axis=0) + 1e-3, atol=1e-5)
    z = model.inputs(x)
    differences = (z[y == 1][:, None] - z[y == 0][None]).reshape(-1, z.shape[1])
    wrong = 1 / (1 + np.exp(differences @ model.weights))
    gradient = -(wrong @ differences) / len(differences) + quality.RIDGE * model.weights
    assert len(differences) > 10_000 and np.abs(gradient).max() < 1e-3 < np.abs(differences.mean(axis=0) / 2).max()


@pytest.mark.parametrize("dealt", [1, 7])
def test_the_model_does_not_depend_on_the_partitions(spark, dealt):
    docs, labels = labelled(spark, random.Random(22), "quality")
    one, other = quality.train(docs.coalesce(3), labels), quality.train(docs.repartition(dealt), labels.repartition(dealt))
    assert all(np.array_equal(getattr(one, f), getattr(other, f)) for f in ("mean", "scale", "weights", "cut"))


def test_the_threshold_counts_every_labelled_row(spark):
    rng = random.Random(23)
    texts = [(i, " ".join(rng.choice(["some", "Words", "12", "...", "x|y"]) for _ in range(rng.randrange(5, 40)))) for i in range(16_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(rng.random() < t.count("some") / 10)) for i, t in texts], "doc_id long, quality int")
    known = quality.score(docs, labels).filter("not held_out").join(labels, "doc_id")
    zeros, rejected = known.filter("quality = 0").count(), known.filter("predicted = 0").count()
    assert rejected == zeros and max(zeros, known.count() - zeros) > 6000  # more than the former sample of a class


@pytest.mark.parametrize("share", [0.0, 0.3, 0.5, 0.9, 1.0])
def test_quantile_equals_sorting(spark, share):
    rng = random.Random(24)
    rows = [(rng.randrange(2), rng.choice([rng.randrange(-(10**11), 10**11), rng.randrange(-50, 50), 7])) for _ in range(900)]
    n = [sum(y == k for y, _ in rows) for k in (0, 1)]
    total, points = 0.0, sorted(p for _, p in rows)
    for p in sorted(set(points)):
        total = sum((share if y == 0 else 1 - share) / n[y] for y, q in rows if q <= p)
        if total >= share - 1e-12:
            break
    after = [q for q in points if q > p]
    want = (p + after[0] + 1) // 2 if after else p
    assert quality.quantile(spark.createDataFrame(rows, "y int, point long"), share) == want
