"""Values that once went wrong: times of day alone, numbers as text, infinities, rows of equal id."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gradeline.config import TableSpec
from gradeline.functions import columns as C
from gradeline.operators import clean, listing, profile
from gradeline.sources import tables


@pytest.mark.parametrize("text,want", [
    ("12:30", None), ("T1", None), ("2024", None), ("2024-05", None), ("", None), ("2024-02-30", None), ("2024-01-01 25:00", None),
    ("2024-01-02", "2024-01-02 00:00:00"), ("2024-01-02T03:04", "2024-01-02 03:04:00"), (" 2024-01-02T03:04:05.5Z ", "2024-01-02 03:04:05.5"),
    ("2024-01-02 03:04:05+02:00", "2024-01-02 01:04:05"), ("2024-01-02 03:04:05 x", None), ("2024-01-02 03:04:05", "2024-01-02 03:04:05"),
])
def test_times_need_a_date(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(C.parse_time(F.col("t")).cast("string")).first()[0] == want


def test_numbers_as_text_obey_the_outlier_rule(spark):
    rows = spark.createDataFrame([(str(v), "a" if v == 1 else str(v), v) for v in (1, 2, 3, 4, 5, 1000)], "x string, y string, z long")
    spec = TableSpec(None, ("x", "y", "z"), "label")
    got = clean.remove_outliers(rows, spec)
    assert sorted(r.x for r in got.collect()) == [1.0, 2.0, 3.0, 4.0, 5.0] and dict(got.dtypes) == {"x": "double", "y": "string", "z": "bigint"}
    with_null = spark.createDataFrame([("1",), (None,), ("2",)], "x string")
    assert dict(clean.numeric_text(with_null, ["x"]).dtypes) == {"x": "double"}


def test_histogram_leaves_infinities_out(spark):
    inf = float("inf")
    rows = spark.createDataFrame([(v, "l") for v in (0.0, 1.0, 2.0, 4.0, inf, -inf, float("nan"), None)], "x double, label string")
    got = {r.bin: (r.bin_start, r.n, r.density) for r in profile.histogram(rows, ["x"], "label", 4).collect()}
    assert got == {0: (0.0, 1, 0.25), 1: (1.0, 1, 0.25), 2: (2.0, 1, 0.25), 3: (3.0, 1, 0.25)}
    assert profile.histogram(rows.where(F.col("x") == inf), ["x"], "label").count() == 0


def test_pages_of_equal_ids_neither_repeat_nor_lose_rows(spark):
    rows = spark.range(97).select((F.col("id") % 3).alias("k"), (F.col("id") * 37 % 97).alias("v"), F.array("id").alias("a")).repartition(5)
    for sizes in ((0, 100), (100, 0), (0, 0)):
        pages = [listing.slice_rows(rows, "k", o, 10, top_rows=sizes[(o // 10) % 2]).collect() for o in range(0, 97, 10)]
        found = [r.v for p in pages for r in p]
        assert found == [r.v for r in rows.orderBy("k", "v").collect()]


def test_rows_without_an_id_come_last(spark):
    rows = spark.createDataFrame([(None,), (2,), (1,)], "id long")
    assert [r.id for r in tables.sample_rows(rows, "id", 2).collect()] == [1, 2]
