"""Changes applied per record in a state store: one outcome per change, without a rewrite of the table per batch.

The stream is grouped by the table's key. Each key's state holds its row, the time of the newest change and the change
ids that it has seen, so a repeated message changes nothing, also after a restart. The state is the table: it starts
from given rows, and the last row of each changed key leaves the operator with the outcome.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQueryListener

from gradeline.operators.changes import OPERATIONS, ORDER, ChangeSpec
from gradeline.sources.change_feed import parse_changes

#: Groups over which changes without a key are spread; they have no state but the ids they were seen by.
UNKEYED_GROUPS = 64
STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
METRICS = "gradeline_changes"


def outcome_schema(row_schema: T.StructType, spec: ChangeSpec) -> T.StructType:
    """What the operator returns for each change: the outcome, both sides of the row and whether it came late."""
    fields = [(f, row_schema[f].dataType) for f in spec.fields]
    names = [
        ("change_id", T.StringType()), (spec.key, row_schema[spec.key].dataType), ("change_time", T.TimestampType()),
        ("operation", T.StringType()), ("user_triggered", T.BooleanType()), ("outcome", T.StringType()), ("error", T.StringType()),
        ("changed_fields", T.ArrayType(T.StringType())), ("late", T.BooleanType()),
        *[(f"old_{f}", t) for f, t in fields], *[(f"new_{f}", t) for f, t in fields],
    ]
    return T.StructType([T.StructField(n, t) for n, t in names])


def _same(a: Any, b: Any) -> bool:
    """Equal as Spark compares: NaN equals NaN."""
    return a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))


def decide(change: Row, held: dict[str, Any] | None, spec: ChangeSpec) -> tuple[str, str | None, list[str], dict[str, Any] | None]:
    """(outcome, error, changed fields, row afterwards) of one change on the row that is held, or on none."""
    op, given = change["operation"], {f: change[f] for f in spec.fields}
    lacking = next((f for f in spec.fields if given[f] is None), None) if op == "insert" else None
    if lacking:
        return "invalid", lacking, [], held
    if op not in OPERATIONS:
        return "unknown", None, [], held
    if change[spec.key] is None:
        return "missing_id", None, [], held
    if op == "insert":
        return ("duplicate", None, [], held) if held is not None else ("ok", None, [spec.key, *spec.fields], given)
    if held is None:
        return "missing", None, [], None
    if op == "delete":
        return "ok", None, [], None
    changed = [f for f in spec.fields if given[f] is not None and not _same(given[f], held[f])]
    after = held | {f: given[f] for f in changed}
    return ("ok" if changed else "unchanged"), None, changed, after


class ChangeProcessor(StatefulProcessor):
    """State of one key: ``row`` (absent: no such row), ``last`` (time of the newest effective change), ``seen`` (change ids)."""

    def __init__(self, row_schema: T.StructType, spec: ChangeSpec, keep_ids_ms: int | None = None):
        self.spec, self.keep_ids_ms = spec, keep_ids_ms
        self.row_schema = T.StructType([T.StructField(f, row_schema[f].dataType) for f in spec.fields])
        self.names = outcome_schema(row_schema, spec).names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.row = handle.getValueState("row", self.row_schema)
        self.last = handle.getValueState("last", "micros long")
        self.seen = handle.getMapState("seen", "change_id string", "present boolean", self.keep_ids_ms)

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        self.row.update(tuple(initialState[f] for f in self.spec.fields))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        fields = self.spec.fields
        held = dict(zip(fields, self.row.get())) if self.row.exists() else None
        last = self.last.get()[0] if self.last.exists() else None
        before = held
        for change in sorted(rows, key=lambda r: tuple((r[c] is not None, r[c] or 0) for c in ORDER)):
            name = change["change_id"]
            if name is not None:
                if self.seen.containsKey((name,)):
                    continue
                self.seen.updateValue((name,), (True,))
            outcome, error, changed, after = decide(change, held, self.spec)
            at = change["_micros"]
            late = None not in (at, last) and at < last
            if outcome == "ok" and at is not None and not late:
                last = at
            old = held if outcome == "ok" else None
            new = after if outcome == "ok" else None
            held = after
            yield Row(*self.names)(
                name, change[self.spec.key], change["change_time"], change["operation"], change["user_triggered"], outcome, error,
                changed if outcome == "ok" else [], late,
                *[(old or {}).get(f) for f in fields], *[(new or {}).get(f) for f in fields],
            )
        if held is None and before is not None:
            self.row.clear()
        elif held is not None and held is not before:
            self.row.update(tuple(held[f] for f in fields))
        if last is not None:
            self.last.update((last,))

    def close(self) -> None:
        pass


def _grouped(rows: DataFrame, spec: ChangeSpec):
    """Rows by key; those without one are spread, as nothing but their ids is kept."""
    spread = F.when(F.col(spec.key).isNull(), F.pmod(F.xxhash64(*rows.columns), F.lit(UNKEYED_GROUPS))).otherwise(F.lit(0))
    return rows.withColumn("_spread", spread.cast("int")).groupBy(spec.key, "_spread")


def apply_keyed(
    changes: DataFrame, base: DataFrame, spec: ChangeSpec, keep_ids_ms: int | None = None
) -> DataFrame:
    """Streaming outcomes of a stream of changes (columns of ``parse_changes``) on a table that starts as ``base``.

    Outcomes are those of ``changes.replay``. Changes of one key are applied in order of (change_time, change_id)
    within a micro-batch and in order of arrival between them; ``late`` marks one older than a change already
    applied. A change id that its key has seen gives no row; ``keep_ids_ms`` bounds how long ids are kept, and
    None keeps them. Ids are known by key: one id under two keys is two changes. Of the base rows that share a key
    one is taken. The session must name the RocksDB state store (``STATE_STORE_CONF``).
    """
    wanted = ["change_id", spec.key, "change_time", F.unix_micros("change_time").alias("_micros"), "operation", *spec.fields, "user_triggered"]
    start = base.where(F.col(spec.key).isNotNull()).groupBy(spec.key).agg(F.min(F.struct(*spec.fields)).alias("_row"))
    start = start.select(spec.key, *[F.col(f"_row.{f}").alias(f) for f in spec.fields])
    return _grouped(changes.select(*wanted), spec).transformWithState(
        ChangeProcessor(base.schema, spec, keep_ids_ms), outcome_schema(base.schema, spec), "update",
        "ProcessingTime" if keep_ids_ms else "None", _grouped(start, spec),
    )


def read_outcomes(messages: DataFrame, base: DataFrame, spec: ChangeSpec, keep_ids_ms: int | None = None) -> DataFrame:
    """Streaming outcomes of JSON messages; unreadable ones have the outcome ``error`` and their text in ``error``."""
    read = parse_changes(messages, base.schema, spec)
    done = apply_keyed(read.where(~F.col("is_error")), base, spec, keep_ids_ms)
    types = dict(done.dtypes)
    known = {"outcome": F.lit("error"), "error": F.col("raw"), **{c: F.col(c) for c in ("change_id", spec.key, "change_time", "operation", "user_triggered")}}
    errors = read.where("is_error").select(*[known.get(c, F.lit(None)).cast(types[c]).alias(c) for c in done.columns])
    return done.union(errors)


# -- counters that come with the batch -----------------------------------------------------------


def counted(outcomes: DataFrame, name: str = METRICS) -> DataFrame:
    """The outcomes, observed: the counters of ``changes.change_counters`` are taken as the rows pass."""
    outcome, op = F.col("outcome"), F.col("operation")
    error, ok = outcome == "error", outcome == "ok"
    return outcomes.observe(
        name, F.count_if(~error).alias("processed"), *[F.count_if(ok & (op == o)).alias(f"{o}_processed") for o in OPERATIONS],
        F.count_if(~ok & ~error).alias("failed"), F.count_if(error).alias("errors"), F.max("change_time").alias("last_time"),
    )


class StreamCounters(StreamingQueryListener):
    """Counters over all batches since the listener was added: nothing is read for them a second time."""

    def __init__(self, name: str = METRICS):
        self.name, self.batches = name, {}

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        progress = event.progress
        if row := progress.observedMetrics.get(self.name):
            self.batches[(str(progress.id), progress.batchId)] = row.asDict()  # a repeated batch counts once

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        pass

    def totals(self) -> dict[str, Any]:
        """The row of ``changes.change_counters``; the success rate is 100 when nothing came."""
        seen = list(self.batches.values())
        names = ("processed", *[f"{o}_processed" for o in OPERATIONS], "failed", "errors")
        sums = {n: sum(b[n] or 0 for b in seen) for n in names}
        n = sums["processed"] + sums["errors"]
        rate = round(100.0 * (n - sums["errors"]) / n, 1) if n else 100.0
        return sums | {"last_time": max((b["last_time"] for b in seen if b["last_time"]), default=None), "success_rate": rate}
