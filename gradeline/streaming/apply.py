"""Change stream to table: parse, apply once, log, count."""

from __future__ import annotations

from concurrent.futures import Future

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gradeline.operators import changes as ops
from gradeline.operators import models
from gradeline.sources.change_feed import parse_changes
from gradeline.sources.versioned import VersionedTable

# Fixed value: how often the stream looks for new messages.
POLL_INTERVAL = "1 second"


def apply_batch(table: VersionedTable, messages: DataFrame, batch: str) -> None:
    """Apply one named batch of messages as the next version of the table.

    Nothing is published back to the source, so an applied change is never
    read again. Unreadable messages become log rows with outcome ``error``.
    """
    read = parse_changes(messages, table.schema(), table.spec)
    good = read.where(~F.col("is_error"))
    errors = read.where("is_error").select(
        "change_id", F.col(table.spec.key).alias("record_id"), "operation", "change_time",
        F.lit("error").alias("outcome"), F.col("raw").alias("detail"),
    )
    table.apply(good.drop("is_error", "raw"), batch, errors)


def start_applying(
    messages: DataFrame,
    table: VersionedTable,
    checkpoint: str,
    available_now: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Start the stream. A batch is named by the query's id and its number, so repeating it changes nothing.

    The id is kept in the checkpoint: a restart goes on under it, and a new checkpoint, also one at
    the same path, has a new one.
    """
    query_id: Future[str] = Future()
    writer = messages.writeStream.foreachBatch(
        lambda batch, batch_id: apply_batch(table, batch, f"{query_id.result()}#{batch_id}")
    ).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if available_now else {"processingTime": POLL_INTERVAL}
    query = writer.trigger(**trigger).start()
    query_id.set_result(query.id)
    return query


def stream_status(query: StreamingQuery) -> dict:
    """Running or stopped, what the stream is doing, and its last progress."""
    progress = query.lastProgress
    return {
        "status": "running" if query.isActive else "stopped",
        "message": query.status["message"],
        "batch_id": progress["batchId"] if progress else None,
        "input_rows": progress["numInputRows"] if progress else 0,
        "timestamp": progress["timestamp"] if progress else None,
    }


def stop(query: StreamingQuery, wait_seconds: int = 5) -> None:
    query.stop()
    query.awaitTermination(wait_seconds)


def table_counters(table: VersionedTable) -> DataFrame:
    """Counters over everything the table's log holds."""
    return ops.change_counters(table.log())


def realtime_status(table: VersionedTable) -> tuple[DataFrame, DataFrame]:
    """The latest effective changes and the counters."""
    return ops.change_history(table.history(), ops.STATUS_ROWS), table_counters(table)


def count_messages(messages: DataFrame, table: VersionedTable) -> DataFrame:
    """Streaming counts per operation and readability, for ``outputMode('complete')``."""
    read = parse_changes(messages, table.schema(), table.spec)
    outcome = F.when(F.col("is_error"), "error").otherwise("processed")
    return read.groupBy("operation", outcome.alias("outcome")).agg(
        F.count("*").alias("n"), F.max("change_time").alias("last_time")
    )


def start_scoring(
    rows: DataFrame, store: str, model: str, out_path: str, checkpoint: str,
    available_now: bool = False,
) -> StreamingQuery:
    """Score a stream of feature rows with a saved model, batch by batch, into Parquet files."""

    def write(batch: DataFrame, batch_id: int) -> None:
        scored = models.score(batch, store, model)
        scored.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": POLL_INTERVAL}
    return writer.trigger(**trigger).start()
