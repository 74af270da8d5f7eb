"""Keyed stream state and observed counters, against the batch replay."""

from __future__ import annotations

import json
import random
import time

import pytest
from pyspark.sql import functions as F

from gradeline.operators import changes as ops
from gradeline.operators.changes import ChangeSpec
from gradeline.plans import inputs
from gradeline.sources import change_feed
from gradeline.streaming import keyed

SF_DIR = "/root/testdata/sf0.001"
SPEC = ChangeSpec("id", ("a", "b"))


@pytest.fixture
def rocks(spark):
    before = spark.conf.get(keyed.STATE_STORE_CONF)
    spark.conf.set(keyed.STATE_STORE_CONF, keyed.STATE_STORE)
    yield spark
    spark.conf.set(keyed.STATE_STORE_CONF, before)


def as_lines(changes, spec):
    """Messages of the changes in their order."""
    out = []
    for r in changes.orderBy(*ops.ORDER).collect():
        row = {f: r[f] for f in (spec.key, *spec.fields) if r[f] is not None}
        out.append(json.dumps({"operation": r["operation"], "timestamp": r["change_time"].isoformat(sep=" "), "change_id": str(r["change_id"]),
                               "record_id": r[spec.key], "user_triggered": r["user_triggered"], "new_data": row}))
    return out


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def run(spark, folder, base, spec, tmp_path, listener=None):
    messages = change_feed.read_messages(spark, str(folder), max_per_trigger=1)
    outcomes = keyed.counted(keyed.read_outcomes(messages, base, spec))
    query = (
        outcomes.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "cp"))
        .foreachBatch(lambda batch, i: batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={i}")).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def test_outcomes_equal_the_replay_across_batches_restarts_and_repeats(rocks, tmp_path):
    spark, spec, rng = rocks, ChangeSpec("record_id", ("value",)), random.Random(4)
    changes, base = inputs.changes(spark, SF_DIR), inputs.base(spark, SF_DIR)
    lines = as_lines(changes, spec)
    cuts = sorted(rng.sample(range(1, len(lines)), 3))
    parts = [lines[a:b] for a, b in zip([0, *cuts], [*cuts, len(lines)])]
    folder = tmp_path / "in"
    for i, part in enumerate(parts[:2]):
        put(folder, f"{i}.json", part)
        time.sleep(0.01)
    run(spark, folder, base, spec, tmp_path)
    put(folder, "again.json", parts[0])  # repeated after a restart
    time.sleep(0.01)
    for i, part in enumerate(parts[2:], 2):
        put(folder, f"{i}.json", part)
        time.sleep(0.01)
    run(spark, folder, base, spec, tmp_path)
    columns = [F.col("change_id").cast("string").alias("change_id"), spec.key, "operation", "outcome", "error", "changed_fields",
               *[f"{s}_{f}" for s in ("old", "new") for f in spec.fields]]
    got = spark.read.parquet(f"{tmp_path}/out").select(*columns)
    want = ops.replay(changes, base, spec).outcomes.select(*columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_counters_come_with_the_batches(rocks, tmp_path):
    spark = rocks
    base = spark.createDataFrame([(i, float(i), f"r{i}") for i in range(6)], "id long, a double, b string")
    row = lambda c, op, key, s, **data: json.dumps({"operation": op, "timestamp": f"2024-01-01 00:00:{s:02d}", "change_id": c, "record_id": key, "new_data": {"id": key, **data}})
    files = [
        [row("c1", "update", 1, 1, a=7.0), row("c2", "insert", 9, 2, a=1.0, b="x"), "{broken"],
        [row("c3", "delete", 2, 3), row("c1", "update", 1, 1, a=7.0), row("c4", "insert", None, 4, a=1.0, b="x"), row("c5", "merge", 3, 5)],
        [row("c6", "update", 1, 6, a=7.0), row("c7", "insert", 2, 0, a=5.0, b="y"), row("c8", "insert", 8, 7, a=5.0)],
    ]
    listener = keyed.StreamCounters()
    spark.streams.addListener(listener)
    try:
        for i, lines in enumerate(files):
            put(tmp_path / "in", f"{i}.json", lines)
            run(spark, tmp_path / "in", base, SPEC, tmp_path)
        deadline = time.time() + 20
        while len(listener.batches) < 3 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    out = spark.read.parquet(f"{tmp_path}/out")
    assert {r.change_id: r.outcome for r in out.collect()} == {
        "c1": "ok", "c2": "ok", None: "error", "c3": "ok", "c4": "missing_id", "c5": "unknown", "c6": "unchanged", "c7": "ok", "c8": "invalid",
    }
    assert [r.change_id for r in out.where("late").collect()] == ["c7"]
    want = ops.change_counters(out).first().asDict()
    assert listener.totals() == want


@pytest.mark.parametrize("held,change,want", [
    (None, ("insert", 1, 1.0, "x"), ("ok", {"a": 1.0, "b": "x"})),
    ({"a": 1.0, "b": "x"}, ("insert", 1, 2.0, "y"), ("duplicate", {"a": 1.0, "b": "x"})),
    ({"a": float("nan"), "b": None}, ("update", 1, float("nan"), None), ("unchanged", None)),
    ({"a": 1.0, "b": "x"}, ("update", 1, None, "y"), ("ok", {"a": 1.0, "b": "y"})),
    (None, ("delete", 1, None, None), ("missing", None)),
    (None, ("insert", None, 1.0, None), ("invalid", None)),
    (None, (None, 1, None, None), ("unknown", None)),
])
def test_one_change(held, change, want):
    got = keyed.decide(dict(zip(("operation", "id", "a", "b"), change)), held, SPEC)
    assert got[0] == want[0] and (want[1] is None or got[3] == want[1])
