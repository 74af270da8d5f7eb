"""The registered queries' inputs, derived row by row from the given tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeline.config import TableSpec

SAMPLE_SPEC = TableSpec(
    id_col="rec_id",
    feature_cols=("size", "weight", "sweetness", "acidity"),
    label_col="quality",
)
LEARN_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size", "p_retailprice")
LEARN_SPEC = TableSpec(id_col="rec_id", feature_cols=LEARN_FEATURES, label_col="quality")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_key() -> F.Column:
    return F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table before cleaning: text numbers, nulls, outliers, label spellings."""
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    size = (
        F.when(order % 97 == 0, F.lit("n/a"))
        .when(order % 89 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("l_quantity").cast("int").cast("string"))
    )
    price = F.col("l_extendedprice")
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        line_key().alias("rec_id"),
        size.alias("size"),
        F.when(part % 53 == 0, price * 10).otherwise(price).alias("weight"),
        F.when(part % 61 != 0, F.col("l_discount")).alias("sweetness"),
        F.col("l_tax").alias("acidity"),
        F.when(flag == "A", "Good").when(flag == "N", "BAD").otherwise("returned").alias("quality"),
    )


def samples_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``samples`` with a second copy of some rows."""
    order = F.split("rec_id", "-")[0].cast("long")
    copies = F.when(order % 101 == 0, 2).otherwise(1)
    rows = samples(spark, sf_dir)
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def learnable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their part and a label the features decide."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    rows = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    unit_price = F.col("l_extendedprice") / F.col("l_quantity") * (1 - F.col("l_discount"))
    return rows.select(
        line_key().alias("rec_id"), *LEARN_FEATURES,
        (unit_price > 2400).cast("int").alias("quality"),
    )


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event stream read as a list of row changes.

    Odd users name keys that are absent at the start; some inserts lack the value, and some updates and
    deletes lack the key.
    """
    kind = F.col("event_type")
    operation = (
        F.when(kind == "signup", "insert")
        .when(kind.isin("purchase", "click"), "update")
        .when(kind == "error", "delete")
        .otherwise("unknown")
    )
    named = ~kind.isin("purchase", "click", "error") | (F.col("event_id") % 19 != 0)
    filled = (kind != "signup") | (F.col("event_id") % 17 != 0)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("change_id"),
        F.when(named, F.when(F.col("user_id") % 2 == 0, F.col("user_id")).otherwise(-F.col("user_id"))).alias("record_id"),
        F.col("ts").alias("change_time"),
        operation.alias("operation"),
        F.when(filled, F.floor(F.col("value") / 20)).alias("value"),
        F.lit(True).alias("user_triggered"),
    )


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows present before the changes."""
    customer = table(spark, sf_dir, "customer")
    return customer.select(
        F.col("c_custkey").alias("record_id"),
        F.floor(F.col("c_acctbal") / 1000).alias("value"),
    )
