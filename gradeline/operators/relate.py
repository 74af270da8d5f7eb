"""Relations between features and the label, and the ranked insights drawn from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.functions import columns as C
from gradeline.operators.profile import unpivot

# Limits of the importance rule.
CONTROL_R = 0.3
CONTROL_GAP = 1.0
SECONDARY_R = 0.15
TOP_FEATURES = 5


def _number(name: str) -> Column:
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def pearson(x: Column, y: Column, complete: bool = False) -> Column:
    """Pearson r over the rows where both are present; NULL when either is constant.

    ``complete=True`` promises that no value is missing, so the deviations of a
    column can be shared between its pairs.
    """
    xs = x if complete else F.when(y.isNotNull(), x)
    ys = y if complete else F.when(x.isNotNull(), y)
    spread = F.stddev_pop(xs) * F.stddev_pop(ys)
    return F.covar_pop(x, y) / F.nullif(spread, F.lit(0.0))


def label_correlation(df: DataFrame, cols: Sequence[str], label_col: str) -> DataFrame:
    """Correlation of each feature with the label, in one aggregate."""
    y = _number(label_col)
    row = df.agg(*[pearson(_number(c), y).alias(f"{c}__r") for c in cols])
    return unpivot(row, cols, ["r"], "feature")


def corr_matrix(df: DataFrame, cols: Sequence[str], complete: bool = False) -> DataFrame:
    """Correlations of all pairs of columns; only the upper half is computed."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[
        pearson(_number(a), _number(b), complete).alias(f"{a}|{b}") for a, b in pairs
    ])
    entries = []
    for a, b in pairs:
        for left, right in {(a, b), (b, a)}:
            entries.append(F.struct(
                F.lit(left).alias("feature_a"), F.lit(right).alias("feature_b"),
                F.col(f"`{a}|{b}`").alias("r"),
            ))
    return row.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")


def scaler_stats(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each column: one row on the driver."""
    aggs = [a for c in cols for a in (F.avg(_number(c)).alias(f"{c}__mean"),
                                      F.stddev_pop(_number(c)).alias(f"{c}__std"))]
    row = df.agg(*aggs).first()
    return {c: (row[f"{c}__mean"], row[f"{c}__std"]) for c in cols}


def standardize(
    df: DataFrame, cols: Sequence[str], stats: dict[str, tuple[float, float]] | None = None
) -> DataFrame:
    """Replace the columns by standard scores; pass the training ``stats`` to scale other rows alike."""
    stats = stats or scaler_stats(df, cols)
    return df.withColumns({
        c: C.z_score(_number(c), F.lit(mean).cast("double"), F.lit(std).cast("double"))
        for c, (mean, std) in stats.items()
    })


def class_profile(df: DataFrame, cols: Sequence[str], label_col: str) -> DataFrame:
    """Average of each feature per class on the 0 to 10 scale, with gap, winner and significance.

    Scaling is linear, so the class averages are scaled instead of the rows:
    one aggregate over the table, no second pass.
    """
    label = F.col(label_col).cast("int")
    aggs: list[Column] = []
    for c in cols:
        v = _number(c)
        aggs += [
            F.avg(v).alias(f"{c}__mean"), F.stddev_pop(v).alias(f"{c}__std"),
            F.avg(F.when(label == 1, v)).alias(f"{c}__high"),
            F.avg(F.when(label == 0, v)).alias(f"{c}__low"),
        ]
    rows = unpivot(df.agg(*aggs), cols, ["mean", "std", "high", "low"], "feature")

    def scaled(name: str) -> Column:
        return C.sigma_scale(C.z_score(F.col(name), F.col("mean"), F.col("std")))

    gap = F.col("high_quality") - F.col("low_quality")
    return (
        rows.select("feature", scaled("high").alias("high_quality"),
                    scaled("low").alias("low_quality"))
        .withColumn("difference", gap)
        .withColumn("advantage", C.advantage(F.col("difference")))
        .withColumn("significant", C.is_significant(F.col("difference")))
        .orderBy(F.desc(F.abs("difference")), "feature")
    )


def correlation_bands(
    correlations: DataFrame,
    thresholds: Sequence[tuple[float, str]] = C.BANDS_CODE,
    lowest: str = "weak",
) -> DataFrame:
    """Strength band and direction of each correlation."""
    r = F.col("r")
    return correlations.withColumns({
        "strength": C.strength_band(r, thresholds, lowest), "direction": C.direction(r),
    })


def correlation_rank(correlations: DataFrame) -> DataFrame:
    """Features by falling |r|; equal strengths by name."""
    size = F.abs("r")
    return correlations.orderBy(F.desc(size), "feature")


def correlation_extremes(correlations: DataFrame) -> DataFrame:
    """Strongest positive, strongest negative and weakest feature; absent when there is none."""
    r, f = F.col("r"), F.col("feature")
    return correlations.agg(
        F.max_by(f, F.when(r > 0, r)).alias("strongest_positive"),
        F.max(F.when(r > 0, r)).alias("strongest_positive_r"),
        F.min_by(f, F.when(r < 0, r)).alias("strongest_negative"),
        F.min(F.when(r < 0, r)).alias("strongest_negative_r"),
        F.min_by(f, F.abs(r)).alias("weakest"),
        F.min_by(r, F.abs(r)).alias("weakest_r"),
    )


def feature_importance(
    correlations: DataFrame, profile: DataFrame, top: int = TOP_FEATURES
) -> DataFrame:
    """Score |r| x class gap, the role it gives a feature, and the best ``top`` features.

    Both inputs have one row per feature, which bounds the broadcast.
    """
    r, gap = F.abs("r"), F.abs("difference")
    role = (
        F.when((r >= CONTROL_R) & (gap >= CONTROL_GAP), "control")
        .when((r >= SECONDARY_R) & (r < CONTROL_R), "secondary")
        .otherwise("other")
    )
    return (
        correlations.join(F.broadcast(profile.select("feature", "difference")), "feature")
        .select("feature", "r", "difference", (r * gap).alias("score"), role.alias("role"))
        .orderBy(F.desc("score"), "feature")
        .limit(top)
    )
