"""Written intermediate tables in the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="gradeline-"))
    return context.getCheckpointDir()


def new_dir(spark: SparkSession, kind: str) -> str:
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def stage(df: DataFrame, kind: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage, survives lost executors, and later passes over it keep
    column pruning and filter pushdown. Non-deterministic columns are fixed.
    """
    path = new_dir(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
