"""Table reads."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the row limit used when the caller gives none that can be read.
DEFAULT_LIMIT = 50


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or Parquet files by path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def run_query(
    spark: SparkSession,
    text: str,
    args: Mapping[str, Any] | None = None,
    limit: int | None = None,
    **tables: DataFrame,
) -> DataFrame:
    """Run the caller's SQL. Values go in as ``:name`` parameters, frames as ``{name}``.

    The limit applies to the result, whatever the text contains.
    """
    result = spark.sql(text, args=dict(args or {}), **tables)
    return result if limit is None else result.limit(limit)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def lookup(df: DataFrame, id_col: str, value: Any) -> DataFrame:
    """Rows with this id; none when it is absent."""
    return df.where(F.col(id_col) == F.lit(value))


def parse_limit(choice: str | int | None, custom: str | int | None = None) -> int | None:
    """Row limit from a user's choice: a number, ``all`` (no limit) or ``custom`` with a number."""
    wanted = custom if choice == "custom" and custom not in (None, "") else choice
    if choice == "all":
        return None
    try:
        n = int(wanted)
    except (TypeError, ValueError):
        return DEFAULT_LIMIT
    return max(n, 1) if choice == "custom" else n


def table_summary(df: DataFrame) -> DataFrame:
    """Row count, column count and column names, in one row."""
    return df.agg(
        F.count("*").alias("total"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(",".join(df.columns)).alias("columns"),
    )


def sample_rows(df: DataFrame, id_col: str, n: int = 5) -> DataFrame:
    """The first rows by id, NULL last."""
    return df.orderBy(F.col(id_col).asc_nulls_last()).limit(n)
