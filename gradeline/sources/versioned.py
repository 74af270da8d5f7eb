"""A changeable table on plain Parquet: every batch of changes writes new files next to the old ones.

Spark cannot overwrite what it reads, and one changed row should not rewrite
the whole table. Rows are spread over parts by a hash of the key; a batch
rewrites the parts it touches and leaves the others where they are.

    root/data/version=N/part=P   rows of part P as of version N
    root/log/version=N           outcome of every change of the batch
    root/manifest/version=N      where each part is; written last, so it commits

A batch that fails before its manifest leaves nothing visible, and the next
attempt overwrites its files. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeline.operators import changes as ops
from gradeline.sources.stage import stage

PARTS = 64
MANIFEST_SCHEMA = "part int, data_version long, batch string"


class VersionedTable:
    """Handle on a table folder; all state is in the folder."""

    def __init__(self, spark: SparkSession, root: str, spec: ops.ChangeSpec, n_parts: int = PARTS):
        self.spark, self.root, self.spec = spark, root.rstrip("/"), spec
        self.n_parts = self._stored_parts() or n_parts  # a table keeps the count it was created with

    def _stored_parts(self) -> int | None:
        """The number of parts that the table was created with."""
        try:
            return int(self.spark.read.text(f"{self.root}/parts").first()[0])
        except AnalysisException:
            return None

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(self.spec.key), F.lit(self.n_parts)).cast("int")

    def create(self, df: DataFrame) -> None:
        """Write the first version."""
        described = self.spark.createDataFrame([(df.schema.json(),)], "value string")
        described.coalesce(1).write.mode("overwrite").text(f"{self.root}/schema")
        count = self.spark.createDataFrame([(str(self.n_parts),)], "value string")
        count.coalesce(1).write.mode("overwrite").text(f"{self.root}/parts")
        self._write_parts(df, 0)
        self._publish(0, {p: 0 for p in self._written_parts(0)}, None)

    def schema(self) -> T.StructType:
        text = self.spark.read.text(f"{self.root}/schema").first()[0]
        return T.StructType.fromJson(json.loads(text))

    def _manifests(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(f"{MANIFEST_SCHEMA}, version long").parquet(
                f"{self.root}/manifest"
            )
        except AnalysisException:
            return None

    def version(self) -> int | None:
        """The last committed version; None before the table is created."""
        found = self._manifests()
        return None if found is None else found.agg(F.max("version")).first()[0]

    def _manifest(self) -> dict[int, int]:
        path = f"{self.root}/manifest/version={self.version()}"
        rows = self.spark.read.schema(MANIFEST_SCHEMA).parquet(path).collect()
        return {r["part"]: r["data_version"] for r in rows if r["data_version"] is not None}

    def _version_of(self, batch: str) -> int | None:
        row = self._manifests().where(F.col("batch") == F.lit(batch)).select("version").first()
        return row[0] if row else None

    def read(self, parts: Sequence[int] | None = None) -> DataFrame:
        """The current rows, or those of some parts only."""
        manifest = self._manifest()
        wanted = manifest if parts is None else [p for p in parts if p in manifest]
        schema = self.schema()
        paths = [f"{self.root}/data/version={manifest[p]}/part={p}" for p in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def log_schema(self) -> str:
        key_type = self.schema()[self.spec.key].dataType.simpleString()
        return (
            f"change_id string, record_id {key_type}, operation string, change_time timestamp, "
            "old_data string, new_data string, changed_fields string, user_triggered boolean, "
            "outcome string, detail string, version long"
        )

    def log(self) -> DataFrame:
        """Outcome of every committed change."""
        schema = self.log_schema()
        try:
            log = self.spark.read.schema(schema).parquet(f"{self.root}/log")
        except AnalysisException:
            return self.spark.createDataFrame([], schema)
        return log.where(F.col("version") <= F.lit(self.version()))

    def history(self) -> DataFrame:
        """The effective changes, as the log queries take them."""
        return self.log().where("outcome = 'ok'").select(*ops.LOG_COLS)

    def apply(
        self, changes: DataFrame, batch: str | None = None, errors: DataFrame | None = None
    ) -> DataFrame:
        """Apply an ordered list of changes as the next version and return its log rows.

        A ``batch`` name that is already committed is not applied again, nor is
        a change whose id is in the log. ``errors`` are log rows of messages
        that could not be read.
        """
        current = self.version()
        if current is None:
            raise ValueError(f"no table at {self.root}")
        done_before = self._version_of(batch) if batch else None
        if done_before is not None:
            return self.log().where(F.col("version") == F.lit(done_before))
        version = current + 1
        fresh = self._new_changes(changes)
        with_key = fresh.where(F.col(self.spec.key).isNotNull())
        touched = [r[0] for r in with_key.select(self._part()).distinct().collect()]
        base = self.read(touched)
        done = ops.replay(fresh, base, self.spec, written=True)
        manifest = self._manifest()
        if touched:
            self._write_parts(ops.apply_state(base, done.state, self.spec), version)
            written = self._written_parts(version)
            manifest = {p: v for p, v in manifest.items() if p not in touched}
            manifest |= {p: version for p in written}
        log = self._log_rows(done.outcomes)
        if errors is not None:
            log = log.unionByName(errors, allowMissingColumns=True)
        log.write.mode("overwrite").parquet(f"{self.root}/log/version={version}")
        self._publish(version, manifest, batch)
        return self.log().where(F.col("version") == F.lit(version))

    def _new_changes(self, changes: DataFrame) -> DataFrame:
        """One row per change id, the earliest one, without the ids the log knows.

        A change without an id gets one, and an insert without a key the next key; both are fixed by the write.
        """
        given = stage(changes.withColumn("change_id", F.coalesce("change_id", F.uuid())), "batch")
        named = ops.first_of_each_id(given)
        # The written batch has a known size: a small one is broadcast into the log scan.
        ids = given.select("change_id")
        seen = self.log().select("change_id").join(ids, "change_id", "left_semi")
        fresh = stage(named.join(seen, "change_id", "left_anti"), "fresh")
        lacks_key = (F.col("operation") == "insert") & F.col(self.spec.key).isNull()
        if fresh.where(lacks_key).isEmpty():
            return fresh
        return stage(ops.assign_ids(fresh, self.read(), self.spec), "numbered")

    def _log_rows(self, outcomes: DataFrame) -> DataFrame:
        spec, op, ok = self.spec, F.col("operation"), F.col("outcome") == "ok"
        old, new = (F.to_json(ops.row_struct(spec, side)) for side in ("old", "new"))
        return outcomes.select(
            "change_id", F.col(spec.key).alias("record_id"), "operation",
            F.col("change_time").cast("timestamp").alias("change_time"),
            F.when(ok & (op != "insert"), old).alias("old_data"),
            F.when(ok & (op != "delete"), new).alias("new_data"),
            F.to_json("changed_fields").alias("changed_fields"),
            "user_triggered", "outcome", F.col("error").alias("detail"),
        )

    def _write_parts(self, df: DataFrame, version: int) -> None:
        # REBALANCE splits a part that is too large for one task and joins small ones.
        parted = df.withColumn("part", self._part()).hint("rebalance", F.col("part"))
        path = f"{self.root}/data/version={version}"
        parted.write.mode("overwrite").partitionBy("part").parquet(path)

    def _written_parts(self, version: int) -> list[int]:
        try:
            found = self.spark.read.parquet(f"{self.root}/data/version={version}")
        except AnalysisException:
            return []
        return [r[0] for r in found.select("part").distinct().collect()]

    def _publish(self, version: int, manifest: dict[int, int], batch: str | None) -> None:
        rows = [(p, v, batch) for p, v in manifest.items()] or [(0, None, batch)]
        entries = self.spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1)
        entries.write.mode("overwrite").parquet(f"{self.root}/manifest/version={version}")
