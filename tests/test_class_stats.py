"""Class statistics: parts add up, changes move them like a new scan, shifts keep digits."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from gradeline.operators import changes as ops
from gradeline.operators import class_stats as cs
from gradeline.operators.changes import ChangeSpec

SCHEMA = "id long, a double, b double, label string"


def table(spark, n=200, seed=1, far=0.0):
    rng = np.random.default_rng(seed)
    rows = [(i, far + float(rng.normal()), None if i % 9 == 0 else float(rng.integers(0, 9)), ["x", "y", None][i % 3]) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def shown(df):
    return sorted(str(tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in r)) for r in df.select(*sorted(df.columns)).collect())


def test_parts_add_up_and_moments_are_those_of_numpy(spark):
    rows = table(spark)
    whole = cs.moments(cs.class_stats(rows, ("a", "b"), "label"))
    parts = cs.moments(cs.combine(*[cs.class_stats(rows.where(F.col("id") % 4 == k), ("a", "b"), "label") for k in range(4)]))
    assert shown(whole) == shown(parts)
    frame = rows.where("label = 'x' and b is not null").toPandas()
    got = whole.where("label = 'x' and f = 'a' and g = 'b'").first()
    assert got.n == len(frame) and got.covariance == pytest.approx(np.cov(frame.a, frame.b, bias=True)[0, 1])
    assert got.r == pytest.approx(np.corrcoef(frame.a, frame.b)[0, 1])
    assert whole.where("label = 'all' and f = 'a' and g = 'a'").first().n == 200


def test_a_shift_keeps_the_digits_of_features_far_from_zero(spark):
    rows, shift = table(spark, far=1e9), {"a": 1e9}
    got = cs.moments(cs.class_stats(rows, ("a", "b"), "label", shift=shift), shift).where("label = 'y' and f = 'a' and g = 'a'").first()
    values = np.array([r.a for r in rows.where("label = 'y'").collect()])
    assert got.mean_f == pytest.approx(values.mean()) and got.covariance == pytest.approx(values.var(), rel=1e-6)


def test_changes_move_the_statistics(spark):
    spec = ChangeSpec("id", ("a", "b", "label"))
    base = table(spark).where("b is not null and label is not null")
    rows = [(f"c{i}", i % 230, f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}", ["insert", "update", "delete", "update"][i % 4], float(i % 5), float(i % 3), ["x", "y", "z"][i % 3], True) for i in range(600)]
    changes = spark.createDataFrame(rows, "change_id string, id long, change_time string, operation string, a double, b double, label string, user_triggered boolean")
    changes = changes.withColumn("change_time", F.col("change_time").cast("timestamp"))
    images = cs.changed_images(ops.replay(changes, base, spec).outcomes, spec)
    moved = cs.combine(cs.class_stats(base, ("a", "b"), "label"), cs.class_stats(images, ("a", "b"), "label", "_weight"))
    anew = cs.class_stats(ops.apply_changes(changes, base, spec), ("a", "b"), "label")
    assert shown(cs.moments(moved)) == shown(cs.moments(anew))


def test_no_rows_and_classes_that_vanish(spark):
    rows = table(spark)
    assert cs.moments(cs.class_stats(rows.limit(0), ("a", "b"), "label")).count() == 0
    gone = rows.where("label = 'x'").withColumn("_weight", F.lit(-1))
    left = cs.combine(cs.class_stats(rows, ("a", "b"), "label"), cs.class_stats(gone, ("a", "b"), "label", "_weight"))
    assert {r.label for r in left.collect()} == {"y", None}
