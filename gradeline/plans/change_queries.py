"""Registered queries on the change list."""

from __future__ import annotations

from pyspark.sql import functions as F

from gradeline.functions import columns as C
from gradeline.operators import changes as ops
from gradeline.operators import class_stats
from gradeline.plans.inputs import base, changes, table
from gradeline.sources.change_feed import parse_changes as parse_messages
from gradeline.sources.stage import stage

SPEC = ops.ChangeSpec(key="record_id", fields=("value",))
SHOWN_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _replay(spark, sf_dir):
    return ops.replay(changes(spark, sf_dir), base(spark, sf_dir), SPEC)


def _flat(df, *nullable):
    """Times, lists and ``nullable`` columns as text, for comparison across engines."""
    shown = {c: F.col(c).cast("string") for c in nullable}
    if "change_time" in df.columns:
        shown["change_time"] = F.date_format("change_time", SHOWN_TIME)
    if "changed_fields" in df.columns and dict(df.dtypes)["changed_fields"] != "string":
        shown["changed_fields"] = F.array_join("changed_fields", ",")
    return df.withColumns(shown)


def _log(spark, sf_dir):
    return ops.change_log_rows(_replay(spark, sf_dir).outcomes, SPEC)


def apply_outcomes(spark, sf_dir):
    done = _replay(spark, sf_dir).outcomes
    names = ("change_id", "record_id", "operation", "outcome", "old_value", "new_value")
    return _flat(done.select(*names), "record_id", "old_value", "new_value")


def apply_changes(spark, sf_dir):
    return ops.apply_changes(changes(spark, sf_dir), base(spark, sf_dir), SPEC)


def changed_fields(spark, sf_dir):
    done = _replay(spark, sf_dir).outcomes.where("outcome = 'ok'")
    return _flat(done.select("change_id", "operation", "changed_fields"))


def insert_rows(spark, sf_dir):
    new = changes(spark, sf_dir).where("operation = 'insert'")
    return ops.insert_rows(base(spark, sf_dir), new, SPEC)


def update_rows(spark, sf_dir):
    updates = changes(spark, sf_dir).where("operation = 'update'")
    return ops.update_rows(base(spark, sf_dir), ops.last_values(updates, SPEC), SPEC)


def delete_rows(spark, sf_dir):
    gone = changes(spark, sf_dir).where("operation = 'delete'")
    return ops.delete_rows(base(spark, sf_dir), gone, "record_id")


def change_messages(spark, sf_dir):
    return ops.change_messages(_replay(spark, sf_dir).outcomes, SPEC)


def change_log_rows(spark, sf_dir):
    return _flat(_log(spark, sf_dir))


def change_history(spark, sf_dir):
    return _flat(ops.change_history(_log(spark, sf_dir)))


def changes_since(spark, sf_dir):
    return _flat(ops.changes_since(_log(spark, sf_dir), "2024-01-15T00:00:00Z", 100))


def change_summary(spark, sf_dir):
    return ops.change_summary(_replay(spark, sf_dir).outcomes)


def _messages(spark, sf_dir):
    """Messages from the events; some are broken by rule."""
    every = changes(spark, sf_dir)
    row = F.struct("record_id", "value")
    text = F.to_json(F.struct(
        "operation",
        F.date_format("change_time", ops.MESSAGE_TIME_FORMAT).alias("timestamp"),
        "change_id", "record_id",
        F.when(F.col("operation") != "update", row).alias("data"),
        F.when(F.col("operation") == "update", row).alias("new_data"),
        "user_triggered",
    ))
    broken = F.col("change_id").cast("long") % 50 == 0
    return every.select(F.when(broken, F.substring(text, 1, 20)).otherwise(text).alias("value"))


def parse_changes(spark, sf_dir):
    schema = base(spark, sf_dir).schema
    read = parse_messages(_messages(spark, sf_dir), schema, SPEC)
    return _flat(read, "record_id", "value", "user_triggered")


def change_counters(spark, sf_dir):
    rows = base(spark, sf_dir)
    read = stage(parse_messages(_messages(spark, sf_dir), rows.schema, SPEC))
    good = ops.replay(read.where("NOT is_error"), rows, SPEC).outcomes
    bad = read.where("is_error").select(
        "operation", "change_time", F.lit("error").alias("outcome")
    )
    shared = good.select("operation", "change_time", "outcome").unionByName(bad)
    return _flat(ops.change_counters(shared)).withColumn(
        "last_time", F.date_format("last_time", SHOWN_TIME)
    )


def parse_changed_fields(spark, sf_dir):
    """JSON lists from the events: good, broken and missing ones."""
    event = F.col("event_id")
    text = (
        F.when(event % 11 == 0, F.lit(None).cast("string"))
        .when(event % 7 == 0, F.concat(F.lit('["'), F.col("event_type")))
        .otherwise(F.concat(F.lit('["'), F.col("event_type"), F.lit('","value"]')))
    )
    fields = C.parse_string_list(text)
    return table(spark, sf_dir, "events").select(
        "event_id", F.size(fields).alias("n_fields"), F.array_join(fields, ",").alias("fields")
    )


def parse_times(spark, sf_dir):
    """Time texts from the events in the two accepted forms, and unreadable ones."""
    event = F.col("event_id")
    text = (
        F.when(event % 13 == 0, F.lit("soon"))
        .when(event % 17 == 0, F.lit("12:30"))
        .when(event % 19 == 0, F.lit("T1"))
        .when(event % 23 == 0, F.lit("2024"))
        .when(event % 29 == 0, F.date_format("ts", "yyyy-MM-dd"))
        .when(event % 2 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")))
    )
    return table(spark, sf_dir, "events").select(
        "event_id", F.date_format(C.parse_time(text), SHOWN_TIME).alias("parsed")
    )


def change_ids(spark, sf_dir):
    """Ids made from the content of the changes that bring none."""
    given = changes(spark, sf_dir).withColumn("change_id", F.when(F.col("change_id").cast("long") % 3 == 0, F.col("change_id")))
    return _flat(ops.derived_ids(given, SPEC).select("change_id", "record_id", "change_time", "operation"), "record_id")


def _featured(rows):
    """Two features and a class of a row."""
    label = F.when(F.col("value") >= 5, "high").otherwise("low")
    return rows.withColumns({"rest": F.pmod("record_id", F.lit(7)), "label": label})


def profile_after_changes(spark, sf_dir):
    """Class statistics of the table before the changes, moved on by their old and new rows alone."""
    before = class_stats.class_stats(_featured(base(spark, sf_dir)), ("value", "rest"), "label")
    images = class_stats.changed_images(_replay(spark, sf_dir).outcomes, SPEC)
    moved = class_stats.class_stats(_featured(images), ("value", "rest"), "label", "_weight")
    after = class_stats.moments(class_stats.combine(before, moved))
    return after.withColumns({c: F.round(c, 6) for c in ("mean_f", "mean_g", "covariance", "r")})


QUERIES = {
    f.__name__: f
    for f in (
        apply_outcomes, apply_changes, changed_fields, insert_rows, update_rows, delete_rows,
        change_messages, change_log_rows, change_history, changes_since, change_summary,
        parse_changes, change_counters, parse_changed_fields, parse_times, change_ids, profile_after_changes,
    )
}
