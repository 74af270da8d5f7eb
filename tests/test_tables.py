"""Reads, filters, pages and the probe."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gradeline.operators import listing
from gradeline.sources import stage, tables


@pytest.fixture(scope="module")
def orders(spark):
    return spark.range(57).select(
        "id", (F.col("id") % 5).cast("double").alias("size"),
        F.when(F.col("id") % 2 == 0, "good").otherwise("bad").alias("quality"),
    ).repartition(3)


def test_limits_from_user_choices():
    parse = tables.parse_limit
    assert parse("all") is None and parse("50") == 50 and parse("x") == 50 and parse(None) == 50
    assert parse("custom", "7") == 7 and parse("custom", "0") == 1 and parse("custom", "z") == 50
    assert parse("custom", "") == 50


def test_parameters_are_data_and_the_limit_applies_to_the_result(spark, orders):
    evil = "x' OR '1'='1"
    text = "SELECT *, 'LIMIT' AS note FROM {t} WHERE quality = :q"
    assert tables.run_query(spark, text, {"q": evil}, t=orders).count() == 0
    assert tables.run_query(spark, text, {"q": "good"}, limit=3, t=orders).count() == 3


def test_zero_is_a_bound_and_none_is_not(orders):
    assert listing.filter_rows(orders, ranges={"size": (0, None)}).count() == 57
    assert listing.filter_rows(orders, ranges={"size": (None, 0)}).count() == 12
    assert listing.filter_rows(orders, {"quality": None}, {"size": (None, None)}).count() == 57
    assert listing.filter_rows(orders, {"quality": "bad"}, {"size": (1.0, 2.0)}).count() == 11


def test_pages(orders):
    ids = lambda df: [r["id"] for r in df.collect()]
    assert ids(listing.list_rows(orders, "id", limit=20, offset=50)) == list(range(50, 57))
    info = listing.list_info(orders, limit=20, offset=37).first()
    assert (info["total"], info["has_more"]) == (57, False)
    assert ids(listing.page_rows(orders, "id", 2)) == list(range(10, 20))
    assert ids(listing.page_rows(orders, "id", 99)) == list(range(50, 57))
    assert ids(listing.page_rows(orders, "id", 3, limit=25)) == list(range(20, 25))
    assert ids(listing.page_rows(orders.where("false"), "id", 3)) == []
    assert ids(listing.limit_rows(orders, "id", 4)) == [0, 1, 2, 3]
    assert listing.limit_rows(orders, "id", None).count() == 57


def test_probe(spark, orders):
    probe = lambda df, last: tuple(listing.update_probe(df, "id", last).first())
    assert probe(orders.where("id <> 55"), 50) == (56, 56, True, 6, 5)
    assert probe(orders, 56) == (57, 56, False, 0, 0)
    assert probe(orders, None) == (57, 56, True, 1, 57)
    assert probe(orders.where("false"), None) == (0, 0, False, 0, 0)
    assert probe(orders.where("false"), 3) == (0, 0, False, 0, 0)


def test_lookup_summary_and_tables(spark, orders, tmp_path):
    assert tables.lookup(orders, "id", 7).count() == 1 and tables.lookup(orders, "id", 700).isEmpty()
    assert tuple(tables.table_summary(orders).first()) == (57, 3, "id,size,quality")
    path = str(tmp_path / "t")
    orders.write.parquet(path)
    assert tables.read_table(spark, path).count() == 57
    assert not tables.table_exists(spark, "no_such_table")
    orders.createOrReplaceTempView("some_rows")
    assert tables.table_exists(spark, "some_rows") and tables.read_table(spark, "some_rows").count() == 57


def test_staging_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    got = stage.stage(spark.range(5))
    assert all(folder in f for f in got.inputFiles()) and got.count() == 5
