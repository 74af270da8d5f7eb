"""What the toxicity model is fitted on, and what its thresholds are calibrated on."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from gradeline.llm import toxicity
from tests.llm.test_operators import frame, labelled


def test_thresholds_count_all_rows_outside_the_fit(spark, monkeypatch):
    docs, labels = labelled(spark, random.Random(12), "toxic")
    seen = []
    monkeypatch.setattr(toxicity, "shifts_from", lambda counts, share: seen.append(counts) or np.zeros(len(counts)))
    toxicity.score(docs, labels, per_class=20)
    ids = {r.doc_id for r in toxicity._usable(labels.filter("toxic is not null")).select("doc_id").distinct().collect()}
    rows = docs.filter("doc_id is not null").rdd.map(lambda r: r.doc_id).collect()
    _, fitted, _ = toxicity.train(docs, labels, per_class=20)
    assert len(fitted) == 40 and seen[0].sum() == sum(i in ids and i not in fitted for i in rows) > 200


def test_each_language_has_its_own_cut_shrunk_to_the_global_one():
    counts = np.zeros((3, 2, 2 * toxicity.BOUND * toxicity.CELLS + 1))
    at = lambda logit: round((logit + toxicity.BOUND) * toxicity.CELLS)
    counts[0, 0, at(0)], counts[0, 1, at(2)] = 9000, 1000
    counts[1, 0, at(2)], counts[1, 1, at(4)] = 90, 5  # fewer than 25 toxic rows
    common, own, none = toxicity.shifts_from(counts, 0.1)
    assert none == 1 and abs(own - (5 * 3 + toxicity.SHRINK * 1) / (5 + toxicity.SHRINK)) < 1e-9 and common == 1
    counts[1] *= 1000
    assert abs(toxicity.shifts_from(counts, 0.1)[1] - 3) < 0.02
    assert not toxicity.shifts_from(counts * [[[1], [0]]], 0.1).any()


def test_long_texts_do_not_end_the_fit(spark):
    docs, labels = labelled(spark, random.Random(13), "toxic")
    first = "concat(text, repeat(' filler', 20000))"  # every row that comes early in digest order is longer than the bound
    long = docs.withColumn("text", F.expr(f"case when md5(cast(doc_id as string)) < '2' then {first} else text end"))
    assert 20 < long.filter("length(text) > 100000").count() < 100
    held = toxicity.score(long, labels, fit_words=36_000).filter("held_out and doc_id < 400").join(labels.filter("toxic is not null").distinct(), "doc_id")
    assert held.filter("predicted = toxic").count() > 0.85 * held.count() > 40


def test_fitting_rows(spark):
    texts = [(i, "a " * (50 if i % 3 else 5), i % 2) for i in range(30)] + [(90, "b " * 999, 2)]
    rows = spark.createDataFrame(texts, "doc_id long, text string, y int")
    assert {y for _, y in toxicity.fitting_rows(rows, 8)} == {0, 1}
    chosen = toxicity.fitting_rows(rows, 300)
    size = {i: 50 if i % 3 else 5 for i in range(30)}
    for y in (0, 1):
        total = sum(size[i] for i, own in chosen if own == y)
        assert total <= 150 and all(total + size[i] > 150 for i in range(30) if i % 2 == y and (i, y) not in chosen)
