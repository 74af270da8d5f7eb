"""The change log as a catalog table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.operators.changes import LOG_COLS

# The columns of the log table.
LOG_TABLE_SCHEMA = """
    change_id STRING, record_id BIGINT, operation STRING, change_time TIMESTAMP,
    old_data STRING, new_data STRING, changed_fields STRING, user_triggered BOOLEAN,
    change_date DATE
"""


def create_change_log(spark: SparkSession, name: str) -> None:
    """Create the log table, partitioned by day, unless it is there."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({LOG_TABLE_SCHEMA}) USING parquet "
        "PARTITIONED BY (change_date)"
    )


def append_change_log(rows: DataFrame, name: str) -> None:
    """Append the log rows of a whole change set at once."""
    spark = rows.sparkSession
    create_change_log(spark, name)
    dated = rows.select(*LOG_COLS, F.to_date("change_time").alias("change_date"))
    dated.select(*spark.table(name).columns).write.mode("append").insertInto(name)


def read_change_log(spark: SparkSession, name: str) -> DataFrame:
    """The log; created empty when it is missing."""
    if not spark.catalog.tableExists(name):
        create_change_log(spark, name)
    return spark.table(name)
