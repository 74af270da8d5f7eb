"""Cases that once lost, mixed up or accepted wrong data."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from gradeline.operators.changes import ChangeSpec
from gradeline.operators.profile import class_balance
from gradeline.operators.ranks import order_statistics
from gradeline.operators.sampling import mark_picks
from gradeline.sources.change_feed import parse_changes
from gradeline.sources.versioned import VersionedTable

SPEC = ChangeSpec("id", ("v",))
ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])


def test_unreadable_time_is_an_error(spark):
    text = '{"change_id": "%s", "timestamp": %s, "operation": "UPDATE", "record_id": 1, "new_data": {"v": 1.0}}'
    rows = [(text % ("a", '"2024-01-05 07:00:00"'),), (text % ("b", '"soon"'),), (text % ("c", "null"),)]
    got = parse_changes(spark.createDataFrame(rows, "value string"), ROW, SPEC).orderBy("change_id").collect()
    assert [r.is_error for r in got] == [False, True, False]


def test_boolean_labels_are_picked(spark):
    df = spark.createDataFrame([(i, i % 2 == 0) for i in range(40)], "id long, y boolean")
    got = mark_picks(df, "y", ["id"], {True: 5, False: 20}, {True: 20, False: 20}, 1)
    assert {(r.y, r.n) for r in got.where("picked").groupBy("y").count().withColumnRenamed("count", "n").collect()} == {(True, 5), (False, 20)}


def test_missing_group_raises(spark):
    rows = spark.createDataFrame([("a", 1.0)], "feature string, value double")
    with pytest.raises(ValueError, match="no rows"):
        order_statistics(rows, {"b": [3]}, {"b": (10, 0.0, 100.0)})


def test_null_is_not_a_class(spark):
    df = spark.createDataFrame([(None,)] * 3 + [(0,)] * 4 + [(1,)] * 5, "y int")
    assert class_balance(df, "y").first().n_classes == 2


def test_table_keeps_its_part_count(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    VersionedTable(spark, root, SPEC, n_parts=7).create(spark.createDataFrame([(i, 1.0) for i in range(50)], ROW))
    assert VersionedTable(spark, root, SPEC, n_parts=3).n_parts == 7

