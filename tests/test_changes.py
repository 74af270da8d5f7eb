"""The replay against a plain one-by-one application, and the log queries."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from gradeline.operators import changes as ops

SPEC = ops.ChangeSpec("id", ("a", "b"))
SCHEMA = (
    "change_id string, id long, t long, operation string, a long, b string, user_triggered boolean"
)


def frame(spark, items):
    df = spark.createDataFrame([(*i, True) for i in items], SCHEMA)
    return df.withColumn("change_time", F.timestamp_seconds("t")).drop("t")


def one_by_one(items, base):
    """Reference application: (outcome per change, final rows)."""
    table = {k: dict(a=a, b=b) for k, a, b in base}
    outcomes = {}
    for cid, key, _, op, a, b in sorted(items, key=lambda i: (i[2], i[0])):
        given = {k: v for k, v in (("a", a), ("b", b)) if v is not None}
        if op not in ops.OPERATIONS:
            result = "unknown"
        elif op == "insert" and len(given) < 2:
            result = "invalid"
        elif key is None:
            result = "missing_id"
        elif op == "insert":
            result = "duplicate" if key in table else "ok"
            table.setdefault(key, given)
        elif key not in table:
            result = "missing"
        elif op == "delete":
            result = "ok"
            del table[key]
        else:
            changed = {k: v for k, v in given.items() if table[key][k] != v}
            result = "ok" if changed else "unchanged"
            table[key] |= changed
        outcomes[cid] = result
    return outcomes, sorted((k, r["a"], r["b"]) for k, r in table.items())


def random_changes(rng, n, n_keys):
    items = []
    for i in range(n):
        key = 0 if rng.random() < 0.4 else rng.randrange(n_keys)
        op = rng.choice(["insert", "update", "update", "update", "delete", "merge"])
        a = rng.choice([None, 0, 1, 2])
        b = rng.choice([None, "x", "y"])
        if op == "insert" and rng.random() < 0.8:
            a, b = a or 0, b or "x"
        items.append((f"c{i:04d}", None if rng.random() < 0.03 else key, rng.randrange(n // 3), op, a, b))
    return items


@pytest.mark.parametrize("hot_key_rows", [10**6, 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_replay_equals_one_by_one(spark, seed, hot_key_rows):
    rng = random.Random(seed)
    items = random_changes(rng, 900, 12)
    base = [(k, rng.randrange(3), rng.choice("xy")) for k in range(0, 24, 2)]
    base_df = spark.createDataFrame(base, "id long, a long, b string")
    done = ops.replay(frame(spark, items), base_df, SPEC, hot_key_rows)
    want_outcomes, want_rows = one_by_one(items, base)
    assert {r["change_id"]: r["outcome"] for r in done.outcomes.collect()} == want_outcomes
    got = sorted(tuple(r) for r in ops.apply_state(base_df, done.state, SPEC).collect())
    assert got == want_rows


def test_old_and_new_values_and_changed_fields(spark):
    base = spark.createDataFrame([(1, 5, "x")], "id long, a long, b string")
    items = [("c1", 1, 1, "update", 6, "x"), ("c2", 1, 2, "update", 7, None),
             ("c3", 1, 3, "delete", None, None), ("c4", 1, 4, "insert", 8, "z")]
    got = ops.replay(frame(spark, items), base, SPEC).outcomes.orderBy("change_id").collect()
    shown = [(r["old_a"], r["new_a"], r["old_b"], r["new_b"], r["changed_fields"]) for r in got]
    assert shown == [
        (5, 6, "x", "x", ["a"]), (6, 7, "x", "x", ["a"]), (7, None, "x", None, []),
        (None, 8, None, "z", ["id", "a", "b"]),
    ]
    assert got[0]["error"] is None


def test_rows_without_id_survive_a_delete_and_repeated_ids_change_together(spark):
    base = spark.createDataFrame(
        [(None, 1, "n"), (1, 1, "x"), (1, 2, "y"), (2, 3, "z")], "id long, a long, b string"
    )
    gone = spark.createDataFrame([(2,)], "id long")
    left = sorted(ops.delete_rows(base, gone, "id").collect(), key=lambda r: r["b"])
    assert [(r["id"], r["b"]) for r in left] == [(None, "n"), (1, "x"), (1, "y")]
    new = ops.apply_changes(frame(spark, [("c1", 1, 1, "update", 9, None)]), base, SPEC)
    assert sorted((r["a"], r["b"]) for r in new.collect()) == [
        (1, "n"), (3, "z"), (9, "x"), (9, "y")]


def test_history_sorts_before_it_limits_and_since_is_strict(spark):
    log = spark.createDataFrame(
        [(f"c{i}", i, "delete", f"2024-01-01 00:00:{i:02d}", None, None, "[bad" if i == 8 else '["a"]', True)
         for i in range(10)],
        "change_id string, record_id long, operation string, change_time string, old_data string,"
        "new_data string, changed_fields string, user_triggered boolean",
    ).withColumn("change_time", F.to_timestamp("change_time")).repartition(4)
    newest = ops.change_history(log, 3).collect()
    assert [r["change_id"] for r in newest] == ["c9", "c8", "c7"]
    assert newest[1]["changed_fields"] == [] and newest[0]["changed_fields"] == ["a"]
    for text in ("2024-01-01T00:00:06Z", "2024-01-01 00:00:06", "2024-01-01T00:00:06.000"):
        assert [r["change_id"] for r in ops.changes_since(log, text).collect()] == ["c9", "c8", "c7"]
    with pytest.raises(ValueError):
        ops.changes_since(log, "yesterday")


def test_counters_of_nothing(spark):
    none = spark.createDataFrame([], "operation string, outcome string, change_time timestamp")
    row = ops.change_counters(none).first()
    assert row["processed"] == 0 and row["success_rate"] == 100.0 and row["last_time"] is None


def test_summary(spark):
    done = spark.createDataFrame([("ok",), ("ok",), ("missing",)], "outcome string")
    assert tuple(ops.change_summary(done).first()) == (3, 2, 1)
