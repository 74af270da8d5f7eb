"""The change stream: parsing, applying once, restart, counters, scoring."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from gradeline.config import TableSpec
from gradeline.operators import models
from gradeline.operators.changes import ChangeSpec
from gradeline.sources import change_feed, change_log
from gradeline.sources.versioned import VersionedTable
from gradeline.streaming import apply as stream

SPEC = ChangeSpec("id", ("a", "b"))


def message(change_id, op, key, a=None, b=None, second=0):
    row = {"id": key, "a": a, "b": b}
    row = {k: v for k, v in row.items() if v is not None}
    body = {
        "operation": op, "timestamp": f"2024-01-01T00:{second // 60:02d}:{second % 60:02d}",
        "change_id": change_id, "record_id": key, "user_triggered": False,
    }
    body["new_data" if op == "update" else "data"] = row
    return json.dumps(body)


def write_lines(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def table(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "table"), SPEC, n_parts=4)
    t.create(spark.createDataFrame(
        [(i, float(i), f"r{i}") for i in range(10)], "id long, a double, b string"
    ))
    return t


def run(spark, table, folder, checkpoint):
    query = stream.start_applying(
        change_feed.read_messages(spark, str(folder)), table, str(checkpoint), available_now=True
    )
    query.awaitTermination()
    return query


def rows(table):
    return sorted(tuple(r) for r in table.read().collect())


def test_stream_applies_changes_and_survives_restart(spark, table, tmp_path):
    folder, checkpoint = tmp_path / "in", tmp_path / "cp"
    first = [
        message("c1", "insert", 100, 1.5, "new", 1),
        message("c2", "update", 3, 33.0, None, 2),
        message("c3", "delete", 4, second=3),
        message("c4", "update", 999, 1.0, None, 4),
        message("c5", "merge", 5, 1.0, None, 5),
        "{broken",
    ]
    write_lines(folder, "a.json", first)
    query = run(spark, table, folder, checkpoint)
    assert stream.stream_status(query)["status"] == "stopped"
    expected = {i: (i, float(i), f"r{i}") for i in range(10)}
    expected[3] = (3, 33.0, "r3")
    expected[100] = (100, 1.5, "new")
    del expected[4]
    assert rows(table) == sorted(expected.values())
    outcomes = {r["change_id"]: r["outcome"] for r in table.log().collect()}
    assert outcomes == {
        "c1": "ok", "c2": "ok", "c3": "ok", "c4": "missing", "c5": "unknown", None: "error"
    }

    # The same messages in a new file (an echo) change nothing; a new one is applied.
    write_lines(folder, "b.json", [*first[:3], message("c6", "update", 100, None, "newer", 6)])
    run(spark, table, folder, checkpoint)
    expected[100] = (100, 1.5, "newer")
    assert rows(table) == sorted(expected.values())
    assert table.version() == 2

    counters = stream.table_counters(table).first()
    assert (counters["processed"], counters["insert_processed"], counters["update_processed"],
            counters["delete_processed"], counters["failed"], counters["errors"]) == (6, 1, 2, 1, 2, 1)
    assert counters["success_rate"] == round(100 * 6 / 7, 1)
    latest, _ = stream.realtime_status(table)
    assert [r["change_id"] for r in latest.collect()] == ["c6", "c3", "c2", "c1"]


def test_repeated_batch_is_not_applied_again(spark, table):
    batch = spark.createDataFrame([(message("x1", "delete", 1),)], "value string")
    stream.apply_batch(table, batch, "s#0")
    before = rows(table)
    stream.apply_batch(table, batch, "s#0")
    assert rows(table) == before and table.version() == 1
    # The first batch of another stream has the same number, not the same name.
    other = spark.createDataFrame([(message("x2", "delete", 2),)], "value string")
    stream.apply_batch(table, other, "t#0")
    assert rows(table) == [r for r in before if r[0] != 2] and table.version() == 2


def test_new_checkpoint_is_a_new_stream(spark, table, tmp_path):
    for n in (1, 2):
        write_lines(tmp_path / f"in{n}", "a.json", [message(f"c{n}", "delete", n)])
        query = run(spark, table, tmp_path / f"in{n}", tmp_path / f"cp{n}")
        names = {r[0] for r in table._manifests().select("batch").collect() if r[0]}
        assert f"{query.id}#0" in names and len(names) == n
    again = run(spark, table, tmp_path / "in2", tmp_path / "cp2")
    assert again.id == query.id and table.version() == 2
    assert [r[0] for r in rows(table)] == [0, *range(3, 10)]


def test_unfinished_version_is_invisible_and_overwritten(spark, table):
    # Files of a version without a manifest: a batch that died half way.
    table._write_parts(table.read().where("id < 5"), 1)
    assert len(rows(table)) == 10
    table.apply(changes(spark, [("d", 9, 1, "delete", None, None)]))
    assert [r[0] for r in rows(table)] == list(range(9))


def changes(spark, items):
    frame = spark.createDataFrame(
        [(c, k, t, op, a, b, True) for c, k, t, op, a, b in items],
        "change_id string, id long, t int, operation string, a double, b string, user_triggered boolean",
    )
    return frame.withColumn("change_time", F.timestamp_seconds("t")).drop("t")


def test_insert_without_id_gets_the_next_ones(spark, table):
    log = table.apply(changes(spark, [
        ("n1", None, 5, "insert", 1.0, "x"), ("n2", None, 4, "insert", 2.0, "y"),
        ("n3", None, 6, "insert", 3.0, None), ("n4", None, 7, "delete", None, None),
    ]))
    assert {(r["change_id"], r["record_id"], r["outcome"], r["detail"]) for r in log.collect()} == {
        ("n2", 10, "ok", None), ("n1", 11, "ok", None),
        ("n3", None, "invalid", "b"), ("n4", None, "missing_id", None),
    }
    assert rows(table)[-2:] == [(10, 2.0, "y"), (11, 1.0, "x")]


def test_part_that_becomes_empty(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), SPEC, n_parts=2)
    t.create(spark.createDataFrame([(1, 1.0, "x")], "id long, a double, b string"))
    t.apply(changes(spark, [("d", 1, 1, "delete", None, None)]))
    assert rows(t) == []
    t.apply(changes(spark, [("i", 1, 2, "insert", 5.0, "z")]))
    assert rows(t) == [(1, 5.0, "z")]


def test_null_message_is_skipped_and_streaming_counts(spark, table, tmp_path):
    folder = tmp_path / "in"
    write_lines(folder, "a.json", [message("c1", "insert", 100, 1.5, "x"), "oops", "[1"])
    counts = stream.count_messages(change_feed.read_messages(spark, str(folder)), table)
    query = (
        counts.writeStream.outputMode("complete").format("memory").queryName("counted")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = {(r["operation"], r["outcome"]): r["n"] for r in spark.table("counted").collect()}
    assert got == {("insert", "processed"): 1, (None, "error"): 2}
    nulls = spark.createDataFrame([(None,)], "value string")
    assert change_feed.parse_changes(nulls, table.schema(), SPEC).count() == 0


def test_message_sink_round_trip(spark, table, tmp_path):
    from gradeline.operators import changes as ops

    batch = changes(spark, [("c1", 1, 1, "update", 9.0, None), ("c2", 2, 2, "delete", None, None)])
    done = ops.replay(batch, table.read(), SPEC).outcomes
    change_feed.write_messages(ops.change_messages(done, SPEC), str(tmp_path / "out"))
    back = change_feed.parse_changes(
        spark.read.text(str(tmp_path / "out")), table.schema(), SPEC
    ).orderBy("change_id").collect()
    assert [(r["change_id"], r["operation"], r["id"], r["a"], r["b"]) for r in back] == [
        ("c1", "update", 1, 9.0, "r1"), ("c2", "delete", 2, 2.0, "r2")]
    assert not any(r["is_error"] for r in back)


def test_change_log_table(spark, table):
    from gradeline.operators import changes as ops

    name = f"log_{random.randrange(10**9)}"
    assert not spark.catalog.tableExists(name)
    assert change_log.read_change_log(spark, name).count() == 0
    done = ops.replay(changes(spark, [("c1", 1, 1, "update", 9.0, None)]), table.read(), SPEC)
    change_log.append_change_log(ops.change_log_rows(done.outcomes, SPEC), name)
    row = change_log.read_change_log(spark, name).first()
    assert json.loads(row["old_data"]) == {"id": 1, "a": 1.0, "b": "r1"}
    assert json.loads(row["new_data"]) == {"id": 1, "a": 9.0, "b": "r1"}
    assert json.loads(row["changed_fields"]) == ["a"]
    spark.sql(f"DROP TABLE {name}")


def test_streaming_scores_equal_batch_scores(spark, tmp_path):
    rng = random.Random(1)
    data = [(i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(200)]
    df = spark.createDataFrame(data, "id long, x double, y double").withColumn(
        "quality", (F.col("x") > 0).cast("int")
    )
    spec = TableSpec("id", ("x", "y"), "quality")
    store = str(tmp_path / "store")
    prepared = models.prepare(df, spec, ["id"], outliers=False)
    models.train_model("logistic_regression", prepared, spec, store)
    rows_dir = str(tmp_path / "rows")
    df.drop("quality").write.parquet(rows_dir)
    source = spark.readStream.schema("id long, x double, y double").parquet(rows_dir)
    query = stream.start_scoring(
        source, store, "logistic_regression", str(tmp_path / "out"), str(tmp_path / "cp"), True
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).drop("batch")
    want = models.score(df.drop("quality"), store, "logistic_regression")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
