"""Row changes on a table: outcomes of an ordered change list, the changed table, the log and its queries.

A change is one row: change_id, the table's key, change_time, operation
(insert, update, delete), the new field values (NULL = not given) and
user_triggered. The order of two changes is (change_time, change_id).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeline.functions import columns as C
from gradeline.operators.ranks import number_rows
from gradeline.sources.stage import stage

# Operations, log query sizes, message time format.
OPERATIONS = ("insert", "update", "delete")
HISTORY_ROWS = 50
RECENT_ROWS = 10
STATUS_ROWS = 5
MESSAGE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

HOT_KEY_ROWS = 1_000_000
LOG_COLS = (
    "change_id", "record_id", "operation", "change_time",
    "old_data", "new_data", "changed_fields", "user_triggered",
)


@dataclass(frozen=True)
class ChangeSpec:
    """Key and value columns of the changed table."""

    key: str
    fields: tuple[str, ...]


@dataclass(frozen=True)
class Replay:
    """``outcomes``: one row per change. ``state``: one row per key with an effective change."""

    outcomes: DataFrame
    state: DataFrame


ORDER = ("change_time", "change_id")


def _last(value: Column) -> Column:
    """Aggregate: the last non-NULL value in change order."""
    return F.max_by(value, F.when(value.isNotNull(), F.struct(*ORDER)))


def _chunks(changes: DataFrame, spec: ChangeSpec, hot_key_rows: int) -> tuple[DataFrame, bool]:
    """Split the change list so that no window holds more than a partition of it.

    Without a hot key a key's changes are one group. With one, the list is
    range-partitioned on key and order and written once: a hot key then spans
    several partitions, and each of them is a group of its own.
    """
    if changes.count() <= hot_key_rows:
        return changes, False
    hottest = changes.groupBy(spec.key).count().agg(F.max("count")).first()[0]
    if hottest is None or hottest <= hot_key_rows:
        return changes, False
    ranged = changes.repartitionByRange(spec.key, *ORDER)
    return stage(ranged.withColumn("_chunk", F.spark_partition_id()), "changes"), True


def _carry(
    summary: DataFrame, spec: ChangeSpec, start: DataFrame, names: Sequence[str]
) -> DataFrame:
    """State before each chunk: the last value from the key's earlier chunks, else the starting state."""
    earlier = (
        Window.partitionBy(spec.key).orderBy("_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = summary.select(
        spec.key, "_chunk", *[F.last(n, ignorenulls=True).over(earlier).alias(n) for n in names]
    )
    joined = before.join(
        start.select(spec.key, *[F.col(n).alias(f"_start{n}") for n in names]), spec.key, "left"
    )
    present = [F.col("_start_live").alias("_was")] if "_live" in names else []
    return joined.select(
        spec.key, "_chunk", *present,
        *[F.coalesce(n, f"_start{n}").alias(f"_in{n}") for n in names],
    )


def replay(
    changes: DataFrame,
    base: DataFrame,
    spec: ChangeSpec,
    hot_key_rows: int = HOT_KEY_ROWS,
    written: bool = False,
) -> Replay:
    """Outcome of every change, as if the list were applied one by one.

    ok, duplicate (insert of a present key), missing (update or delete of an
    absent key), unchanged (update without a difference), invalid (insert
    without a required field), missing_id, unknown (operation).
    Only present keys among the changed ones are looked up in ``base``; the
    base itself is not shuffled while the list of changed keys is small.
    ``written`` stores the replayed rows once, for callers that use both results.
    """
    key, fields = spec.key, spec.fields
    known = F.col("operation").isin(*OPERATIONS)
    tracked = known & F.col(key).isNotNull()
    lacking = F.when(
        F.col("operation") == "insert", C.first_missing([(f, F.col(f)) for f in fields])
    )
    listed = changes.withColumn("error", lacking)
    rows, hot = _chunks(listed.where(tracked), spec, hot_key_rows)
    group = [key, "_chunk"] if hot else [key]

    keys = rows.select(key).distinct()
    start = (
        base.join(keys, key, "left_semi")
        .groupBy(key)
        .agg(F.lit(True).alias("_live"), F.min(F.struct(*fields)).alias("_row"))
        .select(key, "_live", *[F.col(f"_row.{f}").alias(f"_v_{f}") for f in fields])
    )
    values = [f"_v_{f}" for f in fields]

    # Pass 1: does the row exist before the change?
    set_live = F.when(
        (F.col("operation") == "insert") & F.col("error").isNull(), F.lit(True)
    ).when(F.col("operation") == "delete", F.lit(False))
    rows = rows.withColumn("_live", set_live)
    before = (
        Window.partitionBy(*group).orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    )
    if hot:
        lives = rows.groupBy(*group).agg(_last(F.col("_live")).alias("_live"))
        known_before = _carry(lives, spec, start, ["_live"])
    else:
        known_before = start.select(
            key, F.col("_live").alias("_in_live"), F.col("_live").alias("_was"),
            *[F.col(v).alias(f"_in{v}") for v in values],
        )
    rows = rows.join(known_before, group, "left").withColumn(
        "_exists",
        F.coalesce(
            F.last("_live", ignorenulls=True).over(before), F.col("_in_live"), F.lit(False)
        ),
    )

    # Pass 2: which values does the row hold before the change?
    is_insert = F.col("operation") == "insert"
    fresh = is_insert & ~F.col("_exists") & F.col("error").isNull()
    writes = fresh | ((F.col("operation") == "update") & F.col("_exists"))
    rows = rows.withColumn("_fresh", F.when(fresh, True)).withColumns(
        {v: F.when(writes, F.col(f)) for v, f in zip(values, fields)}
    )
    if hot:
        sets = rows.groupBy(*group).agg(*[_last(F.col(v)).alias(v) for v in values])
        rows = rows.join(_carry(sets, spec, start, values), group, "left")
    rows = rows.withColumns({
        f"_old_{f}": F.coalesce(F.last(v, ignorenulls=True).over(before), F.col(f"_in{v}"))
        for v, f in zip(values, fields)
    })

    pairs = [(f, F.col(f"_old_{f}"), F.col(f)) for f in fields]
    differing = C.changed_fields(pairs)
    is_update = F.col("operation") == "update"
    outcome = (
        F.when(is_insert & F.col("error").isNotNull(), "invalid")
        .when(is_insert, F.when(F.col("_exists"), "duplicate").otherwise("ok"))
        .when(~F.col("_exists"), "missing")
        .when(is_update & (F.size(differing) == 0), "unchanged")
        .otherwise("ok")
    )
    rows = rows.withColumn("outcome", outcome)
    if written:
        rows = stage(rows, "replayed")
    state = _final_state(rows, spec)
    ok = F.col("outcome") == "ok"
    had_row, has_row = ok & ~is_insert, ok & (F.col("operation") != "delete")
    lists = (
        F.when(ok & is_update, differing)
        .when(ok & is_insert, F.array(F.lit(key), *[F.lit(f) for f in fields]))
        .otherwise(F.array().cast("array<string>"))
    )
    done = rows.select(
        "change_id", key, "change_time", "operation", "user_triggered", "outcome", "error",
        lists.alias("changed_fields"),
        *[F.when(had_row, F.col(f"_old_{f}")).alias(f"old_{f}") for f in fields],
        *[F.when(has_row, F.coalesce(f, f"_old_{f}")).alias(f"new_{f}") for f in fields],
    )
    types = dict(changes.dtypes)
    empty = {f: F.lit(None).cast(types[f]) for f in fields}
    other = listed.where(~F.coalesce(tracked, F.lit(False))).select(
        "change_id", key, "change_time", "operation", "user_triggered",
        F.when(F.col("error").isNotNull(), "invalid").when(known, "missing_id")
        .otherwise("unknown").alias("outcome"), "error",
        F.array().cast("array<string>").alias("changed_fields"),
        *[c.alias(f"old_{f}") for f, c in empty.items()],
        *[c.alias(f"new_{f}") for f, c in empty.items()],
    )
    return Replay(done.unionByName(other), state)


def _final_state(rows: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Per key with an effective change: does it exist, was it inserted anew, and its last set values."""
    values = [f"_v_{f}" for f in spec.fields]
    ends = rows.groupBy(spec.key).agg(
        _last(F.col("_live")).alias("_live"),
        F.coalesce(F.max("_fresh"), F.lit(False)).alias("_fresh"),
        F.max(F.col("outcome") == "ok").alias("_touched"),
        F.max("_was").alias("_was"),
        *[_last(F.col(v)).alias(v) for v in values],
    )
    live = F.coalesce("_live", "_was", F.lit(False)).alias("_live")
    return ends.where("_touched").select(spec.key, "_fresh", live, *values)


def apply_state(base: DataFrame, state: DataFrame, spec: ChangeSpec) -> DataFrame:
    """The table after a replay: rows of untouched keys, changed rows, and new rows.

    A left join and a union, not a full outer join: with few changed keys Spark
    broadcasts them and the base is read once without a shuffle. Rows without a
    key stay.
    """
    values = {f: f"_v_{f}" for f in spec.fields}
    joined = base.join(state, spec.key, "left")
    stays = F.col("_live").isNull() | (F.col("_live") & ~F.col("_fresh"))
    kept = joined.where(stays).select(*[
        F.coalesce(values[c], c).alias(c) if c in values else F.col(c) for c in base.columns
    ])
    added = state.where(F.col("_live") & F.col("_fresh")).select(
        spec.key, *[F.col(v).alias(f) for f, v in values.items()]
    )
    return kept.unionByName(added, allowMissingColumns=True)


def apply_changes(
    changes: DataFrame, base: DataFrame, spec: ChangeSpec, hot_key_rows: int = HOT_KEY_ROWS
) -> DataFrame:
    """The table after an ordered list of changes.

    The final state, one row per changed key, is written once: it is used for
    the changed rows and for the new ones, and its size is then known.
    """
    state = replay(changes, base, spec, hot_key_rows).state
    return apply_state(base, stage(state, "state"), spec)


# -- set-based edits ---------------------------------------------------------


def next_id(df: DataFrame, key: str) -> int:
    return df.agg(F.coalesce(F.max(key), F.lit(0)) + 1).first()[0]


def assign_ids(changes: DataFrame, base: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Give each complete insert without an id the next free one, in change order."""
    complete = C.first_missing([(f, F.col(f)) for f in spec.fields]).isNull()
    needs = F.coalesce(
        (F.col("operation") == "insert") & F.col(spec.key).isNull() & complete, F.lit(False)
    )
    used = changes.where(F.col("operation") == "insert").agg(F.max(spec.key)).first()[0]
    start = max(next_id(base, spec.key), (used or 0) + 1)
    key_type = base.schema[spec.key].dataType
    numbered = number_rows(changes.where(needs).drop(spec.key), ORDER, spec.key, start)
    typed = numbered.withColumn(spec.key, F.col(spec.key).cast(key_type))
    return changes.where(~needs).unionByName(typed)


def insert_rows(base: DataFrame, rows: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Append complete rows under new ids, numbered on from the largest id in change order."""
    complete = C.first_missing([(f, F.col(f)) for f in spec.fields]).isNull()
    wanted = rows.where(complete).select(*ORDER, *spec.fields)
    numbered = number_rows(wanted, ORDER, spec.key, next_id(base, spec.key))
    return base.unionByName(numbered.select(
        F.col(spec.key).cast(base.schema[spec.key].dataType).alias(spec.key), *spec.fields
    ), allowMissingColumns=True)


def derived_ids(changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Changes whose absent ids are made from their content, so that a repeated message gets the same one.

    The id is the MD5 of key, time (microseconds), operation and values, written as a UUID; a part that is NULL
    differs from an empty one. Equal changes without an id are taken for one message that came twice.
    """
    parts = [F.col(spec.key), F.unix_micros(F.col("change_time").cast("timestamp")), F.col("operation"), *[F.col(f) for f in spec.fields]]
    digest = F.md5(F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts]))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    made = F.concat_ws("-", *[F.substring(digest, at, n) for at, n in cuts])
    return changes.withColumn("change_id", F.coalesce("change_id", made))


def first_of_each_id(changes: DataFrame) -> DataFrame:
    """One change per id: the earliest, and of equally early different ones always the same."""
    columns = [F.col(c) for c in changes.columns]
    first = F.min_by(F.struct(*columns), F.struct("change_time", F.xxhash64(*columns)))
    return changes.groupBy("change_id").agg(first.alias("_first")).select("_first.*")


def last_values(changes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """The last given value of every field per key."""
    return changes.groupBy(spec.key).agg(*[_last(F.col(f)).alias(f) for f in spec.fields])


def update_rows(base: DataFrame, updates: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Set the given fields of the rows with these keys; ``updates`` has one row per key."""
    new = updates.select(spec.key, *[F.col(f).alias(f"_v_{f}") for f in spec.fields])
    return base.join(new, spec.key, "left").select(*[
        F.coalesce(f"_v_{c}", c).alias(c) if c in spec.fields else F.col(c) for c in base.columns
    ])


def delete_rows(base: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Drop the rows with these keys; rows without a key stay."""
    return base.join(keys.select(key).distinct(), key, "left_anti")


# -- messages and log --------------------------------------------------------


def row_struct(spec: ChangeSpec, side: str) -> Column:
    return F.struct(spec.key, *[F.col(f"{side}_{f}").alias(f) for f in spec.fields])


def change_messages(outcomes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """JSON message of each effective change, keyed by record so that a record's changes keep their order.

    Inserts and deletes carry ``data``; updates carry ``old_data``, ``new_data``
    and ``changed_fields``. Absent parts are left out of the JSON.
    """
    op = F.col("operation")
    old, new = row_struct(spec, "old"), row_struct(spec, "new")
    body = F.struct(
        "operation",
        F.date_format("change_time", MESSAGE_TIME_FORMAT).alias("timestamp"),
        "change_id",
        F.col(spec.key).alias("record_id"),
        F.when(op == "insert", new).when(op == "delete", old).alias("data"),
        F.when(op == "update", old).alias("old_data"),
        F.when(op == "update", new).alias("new_data"),
        F.when(op == "update", F.col("changed_fields")).alias("changed_fields"),
        "user_triggered",
        F.lit(1).alias("affected_rows"),
    )
    return outcomes.where(F.col("outcome") == "ok").select(
        F.col(spec.key).cast("string").alias("key"), F.to_json(body).alias("value")
    )


def change_log_rows(outcomes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Log rows of the effective changes; a missing side is NULL."""
    op = F.col("operation")
    return outcomes.where(F.col("outcome") == "ok").select(
        "change_id",
        F.col(spec.key).alias("record_id"),
        "operation",
        "change_time",
        F.when(op != "insert", F.to_json(row_struct(spec, "old"))).alias("old_data"),
        F.when(op != "delete", F.to_json(row_struct(spec, "new"))).alias("new_data"),
        F.to_json("changed_fields").alias("changed_fields"),
        "user_triggered",
    )


def _log_view(log: DataFrame) -> DataFrame:
    names = ("change_id", "record_id", "operation", "change_time", "user_triggered")
    fields = C.parse_string_list(F.col("changed_fields"))
    return log.select(*names, fields.alias("changed_fields"))


def change_history(log: DataFrame, limit: int = HISTORY_ROWS) -> DataFrame:
    """The newest changes, newest first."""
    newest = log.orderBy(F.desc("change_time"), "change_id").limit(limit)
    return _log_view(newest)


def changes_since(log: DataFrame, since: str, limit: int = HISTORY_ROWS) -> DataFrame:
    """The newest changes after a time (``yyyy-MM-dd HH:mm:ss`` or ISO text); unreadable text raises.

    An offset is converted to the session's time zone. A log with days as partitions is read from the
    bound's day on.
    """
    moment = datetime.fromisoformat(since.strip().removesuffix("Z"))
    if moment.tzinfo is not None:
        moment = moment.astimezone(ZoneInfo(log.sparkSession.conf.get("spark.sql.session.timeZone"))).replace(tzinfo=None)
    bound = F.lit(moment.isoformat(sep=" ")).cast(log.schema["change_time"].dataType)
    after = F.col("change_time") > bound
    if "change_date" in log.columns:
        after &= F.col("change_date") >= F.lit(moment.date())
    return change_history(log.where(after), limit)


def change_summary(outcomes: DataFrame) -> DataFrame:
    """Total, successful and failed changes."""
    good = F.count_if(F.col("outcome") == "ok")
    return outcomes.agg(
        F.count("*").alias("total"), good.alias("success"), (F.count("*") - good).alias("failed")
    )


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """Changes per operation and outcome."""
    return outcomes.groupBy("operation", "outcome").agg(F.count("*").alias("n"))


def change_counters(outcomes: DataFrame) -> DataFrame:
    """Counters of a change stream.

    Everything readable counts as processed; ``failed`` are the processed
    changes without effect and ``errors`` the unreadable messages. The success
    rate is over all messages and 100 when there are none.
    """
    outcome, op = F.col("outcome"), F.col("operation")
    error = outcome == "error"
    ok = outcome == "ok"
    n, errors = F.count("*"), F.count_if(error)
    rate = F.round((n - errors) * F.lit(100.0) / F.nullif(n, F.lit(0)), 1)
    return outcomes.agg(
        F.count_if(~error).alias("processed"),
        *[F.count_if(ok & (op == o)).alias(f"{o}_processed") for o in OPERATIONS],
        F.count_if(~ok & ~error).alias("failed"),
        errors.alias("errors"),
        F.max("change_time").alias("last_time"),
        F.coalesce(rate, F.lit(100.0)).alias("success_rate"),
    )
