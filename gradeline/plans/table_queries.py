"""Registered queries on feature tables, record lists and text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeline.functions import columns as C
from gradeline.operators import clean as clean_ops
from gradeline.operators import listing, metrics, profile, relate, sampling
from gradeline.plans.inputs import (
    LEARN_FEATURES, SAMPLE_SPEC, learnable, samples, samples_dup, table,
)
from gradeline.sources import tables

FEATURES = SAMPLE_SPEC.feature_cols
LABEL = SAMPLE_SPEC.label_col
TYPED_COLS = ("rec_id", *FEATURES, LABEL)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round the floating columns, so that engines summing in another order agree."""
    return df.select(*[
        F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def dated(df: DataFrame) -> DataFrame:
    """The order date as text, so that engines with different time units agree."""
    return df.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_ops.clean(samples_dup(spark, sf_dir), SAMPLE_SPEC)


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with numbers as numbers, nulls still in place."""
    return clean_ops.coerce_numeric(samples(spark, sf_dir), FEATURES)


def coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed samples with class codes; the row key is kept for sampling."""
    return clean_ops.map_labels(typed(spark, sf_dir), LABEL, SAMPLE_SPEC.label_map)


# -- scans and lists ---------------------------------------------------------


def scan_raw(spark, sf_dir):
    return dated(tables.read_table(spark, f"{sf_dir}/orders.parquet"))


def scan_query(spark, sf_dir):
    return rounded(tables.run_query(
        spark,
        "SELECT o_orderstatus, count(*) AS n, sum(o_totalprice) AS total_price "
        "FROM {orders} WHERE o_orderpriority = :priority AND o_totalprice > :floor "
        "GROUP BY o_orderstatus",
        args={"priority": "1-URGENT", "floor": 1000.0},
        orders=table(spark, sf_dir, "orders"),
    ), 2)


def lookup(spark, sf_dir):
    return dated(tables.lookup(table(spark, sf_dir, "orders"), "o_orderkey", 77))


LIST_ARGS = {"equals": {"o_orderstatus": "F"}, "ranges": {"o_totalprice": (50000.0, 300000.0)}}


def list_rows(spark, sf_dir):
    return dated(listing.list_rows(
        table(spark, sf_dir, "orders"), "o_orderkey", **LIST_ARGS, limit=20, offset=40
    ))


def list_info(spark, sf_dir):
    return listing.list_info(table(spark, sf_dir, "orders"), **LIST_ARGS, limit=20, offset=40)


def limit_rows(spark, sf_dir):
    limit = tables.parse_limit("custom", "75")
    return dated(listing.limit_rows(table(spark, sf_dir, "orders"), "o_orderkey", limit))


def page_rows(spark, sf_dir):
    return dated(listing.page_rows(table(spark, sf_dir, "orders"), "o_orderkey", page=10**9, top_rows=0))


def page_rows_by_text(spark, sf_dir):
    """A middle page on a text key, by the way that holds deep in a table."""
    return listing.page_rows(samples(spark, sf_dir), "rec_id", page=200, top_rows=0)


def page_rows_ties(spark, sf_dir):
    """A page whose ids repeat, cut among rows of one id, by the way that holds deep in a table."""
    return dated(listing.page_rows(table(spark, sf_dir, "orders"), "o_custkey", page=33, per_page=7, top_rows=0))


def page_info(spark, sf_dir):
    return listing.page_info(table(spark, sf_dir, "orders"), page=10**9)


def row_count(spark, sf_dir):
    return profile.row_count(table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "F")


def update_probe(spark, sf_dir):
    return listing.update_probe(table(spark, sf_dir, "orders"), "o_orderkey", 100)


def table_summary(spark, sf_dir):
    return tables.table_summary(table(spark, sf_dir, "orders"))


def sample_rows(spark, sf_dir):
    return dated(tables.sample_rows(table(spark, sf_dir, "orders"), "o_orderkey"))


# -- cleaning ----------------------------------------------------------------


def drop_nulls(spark, sf_dir):
    return clean_ops.drop_nulls(samples(spark, sf_dir))


def drop_duplicates(spark, sf_dir):
    return clean_ops.drop_duplicates(samples_dup(spark, sf_dir))


def coerce_numeric(spark, sf_dir):
    return clean_ops.coerce_numeric(samples(spark, sf_dir), FEATURES)


def map_labels(spark, sf_dir):
    rows = samples(spark, sf_dir).select("rec_id", LABEL)
    return clean_ops.map_labels(rows, LABEL, SAMPLE_SPEC.label_map)


def clean(spark, sf_dir):
    return cleaned(spark, sf_dir)


def default_features(spark, sf_dir):
    return samples(spark, sf_dir).select(
        "rec_id", *[C.number_or_default(F.col(c)).alias(c) for c in FEATURES]
    )


def remove_outliers(spark, sf_dir):
    rows = clean_ops.drop_nulls(coded(spark, sf_dir))
    return clean_ops.remove_outliers(rows, SAMPLE_SPEC)


def remove_outliers_text(spark, sf_dir):
    """The rule on text columns: one holds numbers only and becomes one, the other is left alone."""
    rows = clean_ops.drop_nulls(coded(spark, sf_dir)).withColumns({
        "weight": F.concat(F.lit(" "), F.col("weight").cast("string")), "acidity": F.concat(F.lit("t"), F.col("acidity").cast("string")),
    })
    return clean_ops.remove_outliers(rows, SAMPLE_SPEC)


# -- profiles ----------------------------------------------------------------


def missing_values(spark, sf_dir):
    return profile.missing_values(typed(spark, sf_dir))


def describe(spark, sf_dir):
    return rounded(profile.describe(typed(spark, sf_dir), FEATURES))


def column_stats(spark, sf_dir):
    return rounded(profile.column_stats(typed(spark, sf_dir)))


def chart_flags(spark, sf_dir):
    return profile.chart_flags(typed(spark, sf_dir), LABEL)


def iqr_bounds(spark, sf_dir):
    return rounded(profile.iqr_table(typed(spark, sf_dir), FEATURES))


def class_counts(spark, sf_dir):
    return profile.class_counts(cleaned(spark, sf_dir), LABEL, FEATURES)


def class_share(spark, sf_dir):
    return profile.class_share(cleaned(spark, sf_dir), LABEL)


def class_balance(spark, sf_dir):
    return rounded(profile.class_balance(table(spark, sf_dir, "labels"), "quality"))


def histogram(spark, sf_dir):
    return rounded(profile.histogram(coded(spark, sf_dir), FEATURES, LABEL))


def top_bins(spark, sf_dir):
    return profile.top_bins(profile.histogram(coded(spark, sf_dir), FEATURES, LABEL))


# -- relations ---------------------------------------------------------------


def _correlations(spark, sf_dir):
    return relate.label_correlation(cleaned(spark, sf_dir), FEATURES, LABEL)


def _learn_correlations(spark, sf_dir):
    return relate.label_correlation(learnable(spark, sf_dir), LEARN_FEATURES, "quality")


def label_correlation(spark, sf_dir):
    return rounded(_correlations(spark, sf_dir))


def corr_matrix(spark, sf_dir):
    return rounded(relate.corr_matrix(coded(spark, sf_dir), [*FEATURES, LABEL]))


def standardize(spark, sf_dir):
    return rounded(relate.standardize(coded(spark, sf_dir), FEATURES))


def class_profile(spark, sf_dir):
    return rounded(relate.class_profile(learnable(spark, sf_dir), LEARN_FEATURES, "quality"))


def correlation_bands(spark, sf_dir):
    r = _learn_correlations(spark, sf_dir)
    both = relate.correlation_bands(r).withColumn(
        "documented_strength", C.strength_band(F.col("r"), C.BANDS_TEXT, "very_weak")
    )
    return rounded(both)


def correlation_rank(spark, sf_dir):
    return rounded(relate.correlation_rank(_learn_correlations(spark, sf_dir)))


def correlation_extremes(spark, sf_dir):
    return rounded(relate.correlation_extremes(_learn_correlations(spark, sf_dir)))


def feature_importance(spark, sf_dir):
    rows = learnable(spark, sf_dir)
    return rounded(relate.feature_importance(
        relate.label_correlation(rows, LEARN_FEATURES, "quality"),
        relate.class_profile(rows, LEARN_FEATURES, "quality"),
    ))


# -- sampling and metrics ----------------------------------------------------


def balance_classes(spark, sf_dir):
    return sampling.balance_classes(table(spark, sf_dir, "labels"), "quality", ["doc_id"])


def stratified_split(spark, sf_dir):
    rows = coded(spark, sf_dir).select("rec_id", LABEL)
    return sampling.stratified_split(rows, LABEL, ["rec_id"])


def _rule_predictions(spark, sf_dir):
    rule = (F.col("l_discount") < 0.05).cast("int")
    return learnable(spark, sf_dir).select("quality", rule.alias("prediction"))


def accuracy(spark, sf_dir):
    counts = metrics.confusion(_rule_predictions(spark, sf_dir), "quality", "prediction")
    return rounded(metrics.accuracy(counts))


def class_report(spark, sf_dir):
    counts = metrics.confusion(_rule_predictions(spark, sf_dir), "quality", "prediction")
    return rounded(metrics.class_report(counts))


# -- text columns ------------------------------------------------------------


def strip_control(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    noisy = F.concat(F.col("text"), F.lit("\x07\t\x0b\x7f end"))
    return docs.select("doc_id", C.strip_control(noisy).alias("text"))


def safe_name(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", C.safe_name(F.col("url")).alias("name"))


def _report_key():
    """Key text from an order: most parse, some have no time, some too few parts."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    clock = F.format_string("%02d-%02d", F.col("o_orderkey") % 24, F.col("o_custkey") % 60)
    return (
        F.when(F.col("o_orderkey") % 31 == 0, F.concat(F.lit("draft_"), day, F.lit("_x")))
        .when(F.col("o_orderkey") % 37 == 0, day)
        .otherwise(F.concat_ws("_", day, clock, F.lit("model"), F.col("o_orderstatus")))
    )


def parse_report_key(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select("o_orderkey", _report_key().alias("key"))
    return keys.select(
        "o_orderkey",
        F.date_format(C.report_time(F.col("key")), "yyyy-MM-dd HH:mm").alias("report_time"),
        C.report_name(F.col("key")).alias("name"),
    )


def mask_secret(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    secret = F.when(F.col("doc_id") % 7 == 0, "").when(
        F.col("doc_id") % 5 == 0, F.substring("source", 1, 4)
    ).otherwise(F.concat("source", F.col("doc_id").cast("string"), F.lit("key")))
    return docs.select("doc_id", C.mask_secret(secret).alias("secret_preview"))


QUERIES = {
    f.__name__: f
    for f in (
        scan_raw, scan_query, lookup, list_rows, list_info, limit_rows, page_rows,
        page_rows_by_text, page_rows_ties, page_info, chart_flags, row_count,
        update_probe, table_summary, sample_rows, drop_nulls, drop_duplicates, coerce_numeric,
        map_labels, clean, default_features, remove_outliers, remove_outliers_text, missing_values, describe,
        column_stats, iqr_bounds, class_counts, class_share, class_balance, histogram, top_bins,
        label_correlation, corr_matrix, standardize, class_profile, correlation_bands,
        correlation_rank, correlation_extremes, feature_importance, balance_classes,
        stratified_split, accuracy, class_report, strip_control, safe_name, parse_report_key,
        mask_secret,
    )
}
