"""Profiles: counts, summary statistics, missing values, classes, histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeline.operators.clean import IQR_REACH, QUARTILES, numeric_columns
from gradeline.operators.ranks import exact_percentiles, long_form

# The quartiles of a numeric summary.
SUMMARY_PROBS = (0.25, 0.5, 0.75)
N_BINS = 20


def is_missing(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _number(name: str) -> Column:
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def unpivot(row: DataFrame, names: Sequence[str], parts: Sequence[str], key: str) -> DataFrame:
    """One row per name from a one-row frame with columns ``<name>__<part>``."""
    entries = [
        F.struct(F.lit(n).alias(key), *[F.col(f"`{n}__{p}`").alias(p) for p in parts])
        for n in names
    ]
    return row.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")


def row_count(df: DataFrame, condition: Column | None = None) -> DataFrame:
    """Rows in all and rows that meet the condition, in one pass."""
    matching = F.count("*") if condition is None else F.count_if(condition)
    return df.agg(F.count("*").alias("total"), matching.alias("matching"))


def _percentile_frame(
    df: DataFrame, values: Mapping[str, Sequence[float | None]], names: Sequence[str]
) -> DataFrame:
    schema = "feature string, " + ", ".join(f"{n} double" for n in names)
    return df.sparkSession.createDataFrame([(c, *v) for c, v in values.items()], schema)


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum of each numeric column."""
    cols = list(cols or numeric_columns(df))
    basic: list[Column] = []
    for c in cols:
        v = _number(c)
        basic += [
            F.count(v).alias(f"{c}__count"), F.avg(v).alias(f"{c}__mean"),
            F.stddev_samp(v).alias(f"{c}__std"), F.min(v).alias(f"{c}__min"),
            F.max(v).alias(f"{c}__max"),
        ]
    row = df.agg(*basic).first()
    parts = ("count", "mean", "std", "min", "max")
    found = {c: [row[f"{c}__{p}"] for p in parts] for c in cols}
    sizes = {c: (n, lo, hi) for c, (n, _, _, lo, hi) in found.items() if n}
    quartiles = exact_percentiles(df, cols, SUMMARY_PROBS, sizes)
    schema = "feature string, count long, mean double, std double, min double, max double, q25 double, q50 double, q75 double"
    return df.sparkSession.createDataFrame([(c, *found[c], *quartiles[c]) for c in cols], schema)


def iqr_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Quartiles and outlier limits of each column as rows."""
    quartiles = _percentile_frame(df, exact_percentiles(df, list(cols), QUARTILES), ["q1", "q3"])
    reach = F.lit(IQR_REACH) * (F.col("q3") - F.col("q1"))
    return quartiles.select(
        "feature", "q1", "q3",
        (F.col("q1") - reach).alias("lower"), (F.col("q3") + reach).alias("upper"),
    )


def chart_flags(df: DataFrame, label_col: str) -> DataFrame:
    """Which charts the table allows: label present, a numeric feature, two numeric columns; with its rows."""
    numeric = numeric_columns(df)
    return df.agg(F.count("*").alias("total")).select(
        "total", F.lit(label_col in df.columns).alias("has_label"),
        F.lit(any(c != label_col for c in numeric)).alias("has_numeric_features"),
        F.lit(len(numeric) >= 2).alias("has_numeric_pair"),
    )


def missing_values(df: DataFrame) -> DataFrame:
    """Missing values per column."""
    counts = [F.count_if(is_missing(df, c)).alias(f"{c}__missing") for c in df.columns]
    return unpivot(df.agg(*counts), df.columns, ["missing"], "feature")


def column_stats(df: DataFrame, approx: bool = False) -> DataFrame:
    """Type, numeric and null flags, distinct count (NULL counts once), minimum and maximum per column.

    Exact distinct counts of several columns make Spark expand every row once
    per column before the shuffle; ``approx=True`` stays at one map-side pass.
    """
    numeric = set(numeric_columns(df))
    aggs: list[Column] = []
    for c in df.columns:
        value = F.when(~is_missing(df, c), F.col(c))
        distinct = F.approx_count_distinct(value) if approx else F.count_distinct(value)
        low, high = (F.min(value), F.max(value)) if c in numeric else (F.lit(None), F.lit(None))
        aggs += [
            distinct.alias(f"{c}__distinct"),
            F.max(is_missing(df, c)).alias(f"{c}__has_null"),
            low.cast("double").alias(f"{c}__min"),
            high.cast("double").alias(f"{c}__max"),
        ]
    rows = unpivot(df.agg(*aggs), df.columns, ["distinct", "has_null", "min", "max"], "feature")
    dtype, is_num = F.lit(None).cast("string"), F.lit(False)
    for c, t in df.dtypes:
        dtype = F.when(F.col("feature") == c, F.lit(t)).otherwise(dtype)
        is_num = F.when(F.col("feature") == c, F.lit(c in numeric)).otherwise(is_num)
    has_null = F.coalesce("has_null", F.lit(False))
    return rows.select(
        "feature", dtype.alias("dtype"), is_num.alias("is_numeric"), has_null.alias("has_null"),
        (F.col("distinct") + has_null.cast("long")).alias("distinct"), "min", "max",
    )


def class_counts(df: DataFrame, label_col: str, feature_cols: Sequence[str]) -> DataFrame:
    """Rows per class, the total and the number of features, from one grouped pass."""
    everything = Window.partitionBy(F.lit(0))
    return (
        df.groupBy(F.col(label_col).alias("label"))
        .agg(F.count("*").alias("n"))
        .select(
            "label", "n", F.sum("n").over(everything).alias("total"),
            F.lit(len(feature_cols)).alias("n_features"),
        )
    )


def class_share(df: DataFrame, label_col: str, digits: int = 1) -> DataFrame:
    """Share of each class in percent."""
    counts = class_counts(df, label_col, ())
    share = F.col("n") * F.lit(100.0) / F.col("total")
    return counts.select("label", "n", F.round(share, digits).alias("share"))


def class_balance(df: DataFrame, label_col: str) -> DataFrame:
    """Largest and smallest class, their sizes, and the share of the smallest.

    Of equally large classes the lowest label counts as the largest class and
    the highest label as the smallest one, so the two always differ. NULL is not a class.
    """
    counts = df.where(F.col(label_col).isNotNull()).groupBy(F.col(label_col).alias("label")).agg(F.count("*").alias("n"))
    by_size = F.struct((-F.col("n")).alias("n"), F.col("label").alias("label"))
    return counts.agg(
        F.count("*").alias("n_classes"), F.sum("n").alias("total"),
        F.min(by_size).alias("big"), F.max(by_size).alias("small"),
    ).select(
        "n_classes", "total",
        F.col("big.label").alias("majority"), (-F.col("big.n")).alias("n_majority"),
        F.col("small.label").alias("minority"), (-F.col("small.n")).alias("n_minority"),
        (-F.col("small.n") / F.nullif(F.col("total"), F.lit(0))).alias("minority_ratio"),
    )


def histogram(
    df: DataFrame, cols: Sequence[str], label_col: str, n_bins: int = N_BINS
) -> DataFrame:
    """Density per feature, class and equal-width bin; missing and infinite values and empty bins are left out.

    Two passes: limits of each feature, then one grouped count of
    features x classes x bins. A constant feature has one bin of width 1.
    """
    spark = df.sparkSession
    finite = {c: F.when(F.abs(_number(c)) < F.lit(float("inf")), _number(c)) for c in cols}
    aggs = [a for c, v in finite.items() for a in (F.min(v).alias(f"{c}__lo"), F.max(v).alias(f"{c}__hi"))]
    row = df.agg(*aggs).first()
    limits = [(c, row[f"{c}__lo"], row[f"{c}__hi"]) for c in cols if row[f"{c}__lo"] is not None]
    limit_df = spark.createDataFrame(
        [(c, lo, (hi - lo) / n_bins if hi > lo else 1.0) for c, lo, hi in limits],
        "feature string, lo double, width double",
    )
    place = F.floor((F.col("value") - F.col("lo")) / F.col("width"))
    bin_no = F.least(place, F.lit(n_bins - 1)).cast("int")
    counted = (
        long_form(df, cols, keep=[label_col])
        .where(F.abs("value") < F.lit(float("inf")))
        .join(F.broadcast(limit_df), "feature")
        .groupBy("feature", F.col(label_col).alias("label"), bin_no.alias("bin"), "lo", "width")
        .agg(F.count("*").alias("n"))
    )
    in_class = F.sum("n").over(Window.partitionBy("feature", "label"))
    left = F.col("lo") + F.col("bin") * F.col("width")
    return counted.select(
        "feature", "label", "bin",
        left.alias("bin_start"), (left + F.col("width")).alias("bin_end"), "n",
        (F.col("n") / (in_class * F.col("width"))).alias("density"),
    )


def top_bins(hist: DataFrame, k: int = 3) -> DataFrame:
    """The k fullest bins of each feature over all classes, the lower bin first on ties."""
    total = hist.groupBy("feature", "bin").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("feature").orderBy(F.desc("n"), "bin")
    return total.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
