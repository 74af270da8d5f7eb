"""Exact ranks and percentiles against numpy, and slices against sorted lists."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gradeline.operators import listing, ranks


def frame(spark, groups):
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    return spark.createDataFrame(rows, "feature string, value double")


def check(spark, groups, cells=8, fine_rows=3):
    wanted = {g: list(range(len(vs))) for g, vs in groups.items()}
    found = ranks.order_statistics(frame(spark, groups), wanted, cells=cells, fine_rows=fine_rows)
    for g, vs in groups.items():
        ordered = sorted(vs)
        for r, v in enumerate(ordered):
            got = found[g, r]
            assert got.value == v
            assert got.below == sum(x < v for x in vs)
            assert got.equal == sum(x == v for x in vs)


def test_frequent_values_infinities_and_wide_ranges(spark):
    check(spark, {
        "hot": [1.0] * 30 + [2.0, 3.0, 2.5] + [4.0] * 5,
        "inf": [-math.inf, math.inf, math.inf, 0.0, 1.0, -1.0, 5e-324, 1e-300],
        "wide": [-1.7e308, 1.7e308, 1.0, 2.0, 1e150, -1e150, 1e-150],
        "one": [7.0] * 9,
        "near": [1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0), 1e17],
    })


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=25))
def test_any_floats(spark, values):
    check(spark, {"g": [v + 0.0 for v in values]}, cells=64, fine_rows=0)


def test_rank_outside_the_rows_is_an_error(spark):
    with pytest.raises(ValueError):
        ranks.order_statistics(frame(spark, {"g": [1.0]}), {"g": [1]})


def test_percentiles_equal_numpy(spark):
    rng = random.Random(3)
    data = [(rng.lognormvariate(0, 3), float(rng.randrange(4)),
             None if i % 5 == 0 else float("nan") if i % 7 == 0 else rng.gauss(0, 1), None)
            for i in range(3000)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = ranks.exact_percentiles(df, ["a", "b", "c", "d"], probs)
    for i, c in enumerate("abc"):
        vs = [r[i] for r in data if r[i] is not None and not math.isnan(r[i])]
        assert got[c] == pytest.approx(list(np.quantile(vs, probs)), rel=1e-12)
    assert got["d"] == [None] * len(probs)


def test_row_numbers_follow_the_order(spark):
    df = spark.range(1000).select((F.xxhash64("id") % 50).alias("x"), "id").repartition(7)
    got = ranks.number_rows(df, ["x", "id"], "n", start=5).orderBy("x", "id").collect()
    assert [r["n"] for r in got] == list(range(5, 1005))


@pytest.mark.parametrize("top_rows", [0, 10**6])
@pytest.mark.parametrize("offset,limit", [(0, 5), (37, 20), (195, 10), (205, 8), (300, 5), (40, None), (0, None)])
def test_slices_equal_the_sorted_list(spark, top_rows, offset, limit):
    ids = [i // 3 for i in range(200)] + [None] * 12  # repeated and missing ids
    data = [(x, n) for n, x in enumerate(ids)]
    df = spark.createDataFrame(data, "id long, n long").repartition(5)
    want = sorted(data, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    end = None if limit is None else offset + limit
    got = listing.slice_rows(df, "id", offset, limit, ties=["n"], top_rows=top_rows).collect()
    ids_got = [r["id"] for r in got]
    assert ids_got == [r[0] for r in want[offset:end]]
    whole = [r for r in want[offset:end] if r[0] is not None]
    assert [(r["id"], r["n"]) for r in got if r["id"] is not None] == whole


def test_percentiles_next_to_infinities(spark):
    df = spark.createDataFrame([(-math.inf,), (1.0,), (2.0,), (math.inf,)], "a double")
    want = df.agg(F.percentile("a", [0.25, 0.5, 0.75])).first()[0]
    assert ranks.exact_percentiles(df, ["a"], [0.25, 0.5, 0.75])["a"] == want == [-math.inf, 1.5, math.inf]


IDS = {
    "string": ["b", "a", None, "c", "ab", "a", None, "Z", "", "d"],
    "double": [3.0, float("nan"), None, 1.0, -math.inf, 3.0, None, 4.0, float("nan"), math.inf],
    "date": [None, *(__import__("datetime").date(2024, 1, d) for d in (3, 1, 2, 9, 9, 4))],
}


@pytest.mark.parametrize("kind", sorted(IDS))
def test_deep_and_shallow_slices_agree_on_any_id_type(spark, kind):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(IDS[kind])], f"id {kind}, n long")
    whole = [r["n"] for r in df.orderBy(F.col("id").asc_nulls_last(), "n").collect()]
    for offset, limit in ((0, 3), (2, 4), (4, None), (5, 9), (9, 1), (30, 2), (3, 0)):
        want = whole[offset:] if limit is None else whole[offset:offset + limit]
        for top_rows in (0, 2, 10**6):
            got = listing.slice_rows(df, "id", offset, limit, ties=["n"], top_rows=top_rows).collect()
            assert [r["n"] for r in got] == want, (offset, limit, top_rows)
