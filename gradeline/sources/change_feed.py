"""The change stream: message schema, parsing, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeline.functions import columns as C
from gradeline.operators.changes import ChangeSpec

BAD_JSON = "_bad_json"


def message_schema(row_schema: T.StructType, spec: ChangeSpec) -> T.StructType:
    """One schema for the three message shapes; every field may be absent."""
    row = T.StructType([
        T.StructField(c, row_schema[c].dataType) for c in (spec.key, *spec.fields)
    ])
    return T.StructType([
        T.StructField("operation", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("change_id", T.StringType()),
        T.StructField("record_id", row_schema[spec.key].dataType),
        T.StructField("data", row),
        T.StructField("old_data", row),
        T.StructField("new_data", row),
        T.StructField("changed_fields", T.ArrayType(T.StringType())),
        T.StructField("user_triggered", T.BooleanType()),
        T.StructField("affected_rows", T.IntegerType()),
        T.StructField(BAD_JSON, T.StringType()),
    ])


def parse_changes(messages: DataFrame, row_schema: T.StructType, spec: ChangeSpec) -> DataFrame:
    """Change rows from JSON text in ``value``.

    Empty messages are skipped. Unreadable ones, also those with an unreadable time, stay as rows with ``is_error``
    set and the text in ``raw``, so one bad message never stops the stream.
    The id of an update names the row and is not itself a field to change.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_JSON}
    body = F.from_json("value", message_schema(row_schema, spec), options)
    read = messages.where(F.col("value").isNotNull()).select("value", body.alias("m"))
    time = C.parse_time(F.col("m.timestamp"))
    bad_time = F.col("m.timestamp").isNotNull() & time.isNull()
    is_error = F.col("m").isNull() | F.col(f"m.{BAD_JSON}").isNotNull() | bad_time
    row_id = F.coalesce("m.record_id", f"m.data.{spec.key}", f"m.new_data.{spec.key}")
    return read.select(
        "m.change_id",
        row_id.alias(spec.key),
        time.alias("change_time"),
        "m.operation",
        *[F.coalesce(f"m.new_data.{f}", f"m.data.{f}").alias(f) for f in spec.fields],
        "m.user_triggered",
        is_error.alias("is_error"),
        F.when(is_error, F.col("value")).alias("raw"),
    )


def read_messages(
    spark: SparkSession,
    path: str | None = None,
    kafka_servers: str | None = None,
    topic: str | None = None,
    starting_offsets: str = "latest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming frame with one text column ``value``: a Kafka topic, or JSON lines in a folder."""
    if kafka_servers:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", kafka_servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
        )
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    reader = spark.readStream.format("text")
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.load(path)


def write_messages(
    messages: DataFrame,
    path: str | None = None,
    kafka_servers: str | None = None,
    topic: str | None = None,
) -> None:
    """Publish ``key``/``value`` rows to a Kafka topic, or append the values to a folder as lines."""
    if kafka_servers:
        (
            messages.select("key", "value").write.format("kafka")
            .option("kafka.bootstrap.servers", kafka_servers)
            .option("topic", topic)
            .save()
        )
    else:
        messages.select("value").write.mode("append").text(path)
