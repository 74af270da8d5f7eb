"""The similarity from which near copies are linked: 0.85 in op3, 0.80 in the pipeline."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from gradeline.llm import near_dedup
from tests.llm.test_operators import frame, prose


def planted(rng):
    """Texts of 120 words and copies with other words at their end; (doc_id, text, similarity in percent)."""
    rows = []
    for i in range(24):
        w = prose(rng, 120, 10**6).split()
        changed = 11 + i % 6  # of 116 shingles so many differ on each side
        rows.append((2 * i, " ".join(w), 100.0))
        rows.append((2 * i + 1, " ".join(w[:-changed] + [f"n{rng.randrange(10**9)}" for _ in range(changed)]), 100 * (116 - changed) / (116 + changed)))
    return rows


def test_stage_drops_near_copies_from_80_percent(spark):
    rows = planted(random.Random(11))
    docs = frame(spark, [(i, t, "s") for i, t, _ in rows])
    assert sum(80 <= p < 85 for _, _, p in rows) >= 8 and any(p < 80 for _, _, p in rows)
    left = {r.doc_id for r in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()}
    assert left == {i for i, _, p in rows if i % 2 == 0 or p < 80}
    kept = {r.doc_id for r in near_dedup.near_groups(docs, 85).filter("kept").collect()}
    assert kept == {i for i, _, p in rows if i % 2 == 0 or p < 85}


def test_plans():
    assert [(near_dedup.plan_for(p).chunks, near_dedup.plan_for(p).distance) for p in (85, 80)] == [(12, 23), (15, 29)]
    assert all(near_dedup.plan_for(p).missed < 1e-5 for p in (75, 80, 85, 90, 100))
    with pytest.raises(ValueError):
        near_dedup.plan_for(30)
