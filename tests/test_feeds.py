"""Streams of a table's committed changes and of a folder's lines, from edit to reader, with restarts."""

from __future__ import annotations

import os

import pytest

from gradeline.operators import changes as ops
from gradeline.operators.changes import ChangeSpec
from gradeline.sources import feeds
from gradeline.sources.change_feed import parse_changes
from gradeline.sources.versioned import VersionedTable

SPEC = ChangeSpec("id", ("a", "b"))
CHANGES = "change_id string, id long, change_time timestamp, operation string, a double, b string, user_triggered boolean"


def changes(spark, rows):
    text = [(c, i, f"2024-01-01 00:00:{s:02d}", op, a, b, True) for c, i, s, op, a, b in rows]
    return spark.createDataFrame(text, CHANGES.replace("timestamp", "string")).selectExpr("* except (change_time)", "cast(change_time as timestamp) as change_time")


@pytest.fixture
def table(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "table"), SPEC, n_parts=4)
    t.create(spark.createDataFrame([(i, float(i), f"r{i}") for i in range(6)], "id long, a double, b string"))
    return t


def publish(table, tmp_path, start="earliest"):
    feeds.start_publishing(table, str(tmp_path / "cp"), str(tmp_path / "sink"), start=start, available_now=True).awaitTermination()


def lines(spark, path):
    return sorted(r.value for r in spark.read.text(str(path)).collect())


def test_committed_changes_are_published_once(spark, table, tmp_path):
    publish(table, tmp_path)  # nothing yet
    table.apply(changes(spark, [("c1", 1, 1, "update", 9.0, None), ("c2", 77, 2, "insert", 0.5, "new"), ("c3", 99, 3, "delete", None, None)]), "b1")
    table.apply(changes(spark, [("c4", 2, 4, "delete", None, None)]), "b2")
    publish(table, tmp_path)
    first = lines(spark, tmp_path / "sink")
    publish(table, tmp_path)  # restart without news
    assert lines(spark, tmp_path / "sink") == first and len(first) == 3
    table.apply(changes(spark, [("c5", 77, 5, "update", 0.25, "x"), ("c1", 1, 1, "update", 9.0, None)]), "b3")
    publish(table, tmp_path)
    base = spark.createDataFrame([(i, float(i), f"r{i}") for i in range(6)], "id long, a double, b string")
    every = changes(spark, [("c1", 1, 1, "update", 9.0, None), ("c2", 77, 2, "insert", 0.5, "new"), ("c3", 99, 3, "delete", None, None),
                            ("c4", 2, 4, "delete", None, None), ("c5", 77, 5, "update", 0.25, "x")])
    want = sorted(r.value for r in ops.change_messages(ops.replay(every, base, SPEC).outcomes, SPEC).collect())
    assert lines(spark, tmp_path / "sink") == want


def test_publishing_from_now_on_leaves_older_versions_out(spark, table, tmp_path):
    table.apply(changes(spark, [("c1", 1, 1, "update", 9.0, None)]), "b1")
    publish(table, tmp_path, "latest")
    table.apply(changes(spark, [("c2", 1, 2, "update", 8.0, None)]), "b2")
    publish(table, tmp_path, "latest")
    assert ["c2" in x for x in lines(spark, tmp_path / "sink")] == [True]


def read_into(spark, folder, tmp_path, start="latest"):
    query = feeds.read_lines(spark, str(folder), start).writeStream.format("parquet").option("path", str(tmp_path / "got"))
    query.option("checkpointLocation", str(tmp_path / "lines-cp")).trigger(availableNow=True).start().awaitTermination()
    return sorted(r.value for r in spark.read.schema("value string").parquet(str(tmp_path / "got")).collect())


def test_lines_start_at_latest_and_restart(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def put(name, text, at):
        (folder / name).write_text(text)
        os.utime(folder / name, ns=(at, at))

    put("old.json", "old\n", 1_000)
    put("_hidden", "hidden\n", 9_000)
    assert read_into(spark, folder, tmp_path) == []
    put("b.json", "one\ntwo\r\n\nthree", 2_000)
    put("a.json", "four\n", 2_000)
    assert read_into(spark, folder, tmp_path) == sorted(["one", "two", "", "three", "four"])
    put("c.json", "", 3_000)
    put("d.json", "x" * 3_000_000 + "\n" + "y\n" * 25_000, 4_000)
    got = read_into(spark, folder, tmp_path)
    assert len(got) == 5 + 25_001 and got.count("old") == 0


def test_lines_from_the_start_and_a_missing_folder(spark, tmp_path):
    assert read_into(spark, tmp_path / "none", tmp_path, "earliest") == []
    with pytest.raises(Exception, match="earliest or latest"):
        read_into(spark, tmp_path, tmp_path / "other", "middle")


def test_edit_store_sink_reader(spark, table, tmp_path):
    """From an edit to the reader's table: published lines are parsed and applied to a copy."""
    copy = VersionedTable(spark, str(tmp_path / "copy"), SPEC, n_parts=2)
    copy.create(table.read())
    for n, rows in enumerate([[("c1", 1, 1, "update", 9.0, None)], [(None, 50, 2, "insert", 1.0, "n"), (None, 3, 3, "delete", None, None)]]):
        table.apply(changes(spark, rows), f"b{n}")
        publish(table, tmp_path)
        read_into(spark, tmp_path / "sink", tmp_path, "earliest")
    messages = spark.read.schema("value string").parquet(str(tmp_path / "got"))
    read = parse_changes(messages, copy.schema(), SPEC)
    assert read.where("is_error or change_id is null").count() == 0  # the store made the absent ids
    copy.apply(read.drop("is_error", "raw"), "all")
    assert sorted(map(tuple, copy.read().collect())) == sorted(map(tuple, table.read().collect()))


def test_the_earliest_of_different_messages_with_one_id_counts(spark, table):
    rows = [("same", 1, 5, "update", 5.0, None), ("same", 1, 2, "update", 2.0, None), ("same", 1, 9, "update", 9.0, None)]
    log = table.apply(changes(spark, rows), "b")
    assert log.count() == 1 and table.read().where("id = 1").first().a == 2.0


def test_derived_ids_repeat_with_the_message(spark):
    rows = [(None, 1, 1, "update", 5.0, None), (None, 1, 1, "update", 5.0, None), (None, 1, 1, "update", 5.0, ""), ("given", 1, 1, "update", 5.0, None)]
    ids = [r.change_id for r in ops.derived_ids(changes(spark, rows), SPEC).collect()]
    assert ids[0] == ids[1] != ids[2] and ids[3] == "given" and [len(p) for p in ids[0].split("-")] == [8, 4, 4, 4, 12]
