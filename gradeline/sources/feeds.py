"""Streaming sources with offsets of their own: the committed changes of a versioned table, and the lines of a folder.

``gradeline_log`` reads the log of a ``VersionedTable``; its offsets are versions, so a batch is a range of versions
and a restart goes on at the next one. ``gradeline_lines`` reads the lines of a folder's files in order of
modification time and path; its offset is the last file read. Both start at "earliest" or "latest".
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery

from gradeline.operators import changes as ops
from gradeline.sources.change_feed import message_schema
from gradeline.sources.versioned import VersionedTable

LOG_FORMAT, LINES_FORMAT = "gradeline_log", "gradeline_lines"
#: Lines that a reader hands out at a time.
BATCH_LINES = 10_000


def _files(path: str, recursive: bool = False) -> tuple[pafs.FileSystem, list[pafs.FileInfo]]:
    """Files below a folder, without hidden ones and those in hidden folders; none where it does not exist yet."""
    fs, root = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True, recursive=recursive))
    shown = [f for f in found if f.type == pafs.FileType.File and not any(p[:1] in ("_", ".") for p in f.path[len(root):].strip("/").split("/"))]
    return fs, shown


def _start(options: dict) -> str:
    start = options.get("start", "latest")
    if start not in ("earliest", "latest"):
        raise ValueError(f"start is earliest or latest, not {start}")
    return start


@dataclass
class FilePart(InputPartition):
    path: str
    version: int = 0


class LogReader(DataSourceStreamReader):
    """Log rows of the versions after one offset up to another; version 0 is the created table and has no log."""

    def __init__(self, root: str, start: str, schema: T.StructType):
        self.root, self.start, self.schema = root.rstrip("/"), start, schema

    def _committed(self) -> int:
        """The last version with a manifest, which is written last."""
        done = [f.path for f in _files(f"{self.root}/manifest", recursive=True)[1]]
        return max((int(p.split("version=")[1].split("/")[0]) for p in done), default=0)

    def initialOffset(self) -> dict:
        return {"version": 0 if self.start == "earliest" else self._committed()}

    def latestOffset(self) -> dict:
        return {"version": self._committed()}

    def partitions(self, start: dict, end: dict) -> list[FilePart]:
        wanted = range(start["version"] + 1, end["version"] + 1)
        return [FilePart(f.path, v) for v in wanted for f in _files(f"{self.root}/log/version={v}")[1]]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        fs = _files(self.root)[0]
        target = to_arrow_schema(self.schema)
        with fs.open_input_file(partition.path) as file:
            for batch in pq.ParquetFile(file).iter_batches():
                have = set(batch.schema.names)
                columns = [batch.column(f.name).cast(f.type) if f.name in have else pa.nulls(batch.num_rows, f.type) for f in target if f.name != "version"]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([partition.version] * batch.num_rows, pa.int64())], schema=target)


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return LOG_FORMAT

    def schema(self) -> T.StructType:
        raise ValueError("give the schema of the table's log: read_log does")

    def streamReader(self, schema: T.StructType) -> LogReader:
        return LogReader(self.options["path"], _start(self.options), schema)


class LinesReader(DataSourceStreamReader):
    """Lines of files in order of (modification time, path). Files must appear whole, and not with a time gone by."""

    def __init__(self, path: str, start: str):
        self.path, self.start = path, start

    def _ordered(self) -> list[tuple[int, str]]:
        return sorted((f.mtime_ns or 0, f.path) for f in _files(self.path)[1])

    def _last(self) -> dict:
        at, path = (self._ordered() or [(0, "")])[-1]
        return {"mtime_ns": at, "path": path}

    def initialOffset(self) -> dict:
        return {"mtime_ns": 0, "path": ""} if self.start == "earliest" else self._last()

    def latestOffset(self) -> dict:
        return self._last()

    def partitions(self, start: dict, end: dict) -> list[FilePart]:
        lo, hi = ((o["mtime_ns"], o["path"]) for o in (start, end))
        return [FilePart(p) for t, p in self._ordered() if lo < (t, p) <= hi]

    def read(self, partition: FilePart) -> Iterator[pa.RecordBatch]:
        fs = _files(self.path)[0]
        lines: list[str] = []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])

        with fs.open_input_stream(partition.path) as raw:
            rest = b""
            while block := raw.read(1 << 20):
                *whole, rest = (rest + block).split(b"\n")
                lines += [w.decode("utf-8", "replace").removesuffix("\r") for w in whole]
                if len(lines) >= BATCH_LINES:
                    yield out()
                    lines = []
            if rest:
                lines.append(rest.decode("utf-8", "replace").removesuffix("\r"))
        yield out()


class LinesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return LINES_FORMAT

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema: T.StructType) -> LinesReader:
        return LinesReader(self.options["path"], _start(self.options))


def read_log(table: VersionedTable, start: str = "latest") -> DataFrame:
    """The table's committed log rows as a stream, from its first change on or from now on."""
    table.spark.dataSource.register(LogSource)
    return table.spark.readStream.format(LOG_FORMAT).schema(table.log_schema()).option("path", table.root).option("start", start).load()


def read_lines(spark: SparkSession, path: str, start: str = "latest") -> DataFrame:
    """Lines of the files of a folder as a stream in ``value``; with "latest" files that are there at the start are not read."""
    spark.dataSource.register(LinesSource)
    return spark.readStream.format(LINES_FORMAT).option("path", path).option("start", start).load()


def log_messages(log: DataFrame, row_schema: T.StructType, spec: ops.ChangeSpec) -> DataFrame:
    """The messages of the effective changes in log rows, as ``changes.change_messages`` makes them from outcomes."""
    row = message_schema(row_schema, spec)["data"].dataType
    sides = log.withColumns({f"_{s}": F.from_json(f"{s}_data", row) for s in ("old", "new")})
    outcomes = sides.select(
        "change_id", F.col("record_id").alias(spec.key), "change_time", "operation", "user_triggered", "outcome",
        F.from_json("changed_fields", "array<string>").alias("changed_fields"),
        *[F.col(f"_{s}.{f}").alias(f"{s}_{f}") for s in ("old", "new") for f in spec.fields],
    )
    return ops.change_messages(outcomes, spec)


def start_publishing(
    table: VersionedTable, checkpoint: str, path: str | None = None, kafka_servers: str | None = None, topic: str | None = None,
    start: str = "latest", available_now: bool = False,
) -> StreamingQuery:
    """Publish every committed change once, to a folder of JSON lines or a Kafka topic.

    The checkpoint holds the version that was published last; Spark's file sink lists each batch's files once.
    Nothing is published to the stream that the table itself reads, unless both are given the same place.
    """
    messages = log_messages(read_log(table, start), table.schema(), table.spec)
    if kafka_servers:
        writer = messages.writeStream.format("kafka").option("kafka.bootstrap.servers", kafka_servers).option("topic", topic)
    else:
        writer = messages.select("value").writeStream.format("text").option("path", path)
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 second"}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
