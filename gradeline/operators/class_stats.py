"""Sufficient statistics per class, kept up to date under inserts, updates and deletes without reading the table again.

A row of the statistics belongs to a class and a pair of features and holds n, sums and the cross product over the rows
that have both. Statistics of parts add up, and a changed row is its old image taken away and its new one added. Means,
variances, covariances, correlations, profiles and the naive Bayes fit follow from them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeline.functions import columns as C
from gradeline.operators.changes import ChangeSpec

SUMS = ("n", "sum_f", "sum_g", "sum_ff", "sum_gg", "sum_fg")
KEYS = ("label", "f", "g")


def class_stats(
    rows: DataFrame, features: Sequence[str], label: str, weight: str | None = None, shift: Mapping[str, float] | None = None
) -> DataFrame:
    """One row per class and pair of features (f before or equal to g in ``features``), from one scan.

    ``weight`` names a column of 1 and -1 for rows added and taken away. ``shift`` is subtracted from a feature
    before it is summed: a value near its mean keeps the digits of features far from 0, and has to be the same for
    all statistics that are added. NaN counts as missing; rows without a class are a class of their own (NULL).
    """
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    value = {f: C.nan_to_null(F.col(f).cast("double")) - F.lit(float((shift or {}).get(f, 0.0))) for f in features}
    pairs = list(combinations_with_replacement(features, 2))

    def total(v: Column, present: Column) -> Column:
        return F.coalesce(F.sum(F.when(present, w * v)), F.lit(0.0))

    aggs = []
    for f, g in pairs:
        x, y = value[f], value[g]
        both = x.isNotNull() & y.isNotNull()
        sums = [total(v, both) for v in (F.lit(1.0), x, y, x * x, y * y, x * y)]
        aggs.append(F.struct(F.lit(f).alias("f"), F.lit(g).alias("g"), *[s.alias(n) for s, n in zip(sums, SUMS)]))
    grouped = rows.groupBy(F.col(label).alias("label")).agg(F.array(*aggs).alias("stats"))
    return grouped.select("label", F.inline("stats"))


def combine(*parts: DataFrame) -> DataFrame:
    """The statistics of several parts, or of a table and its changes, as one; classes without rows go."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    summed = whole.groupBy(*KEYS).agg(*[F.sum(s).alias(s) for s in SUMS])
    alive = summed.groupBy("label").agg(F.max("n").alias("_n")).where(F.col("_n") > 0)
    return summed.join(alive, summed["label"].eqNullSafe(alive["label"]), "left_semi")


def changed_images(outcomes: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Rows added (``_weight`` 1) and taken away (-1) by the effective changes of a replay."""
    op, ok = F.col("operation"), F.col("outcome") == "ok"

    def image(side: str, weight: int) -> Column:
        return F.struct(F.lit(weight).alias("_weight"), F.col(spec.key), *[F.col(f"{side}_{f}").alias(f) for f in spec.fields])

    images = F.array_compact(F.array(F.when(ok & (op != "insert"), image("old", -1)), F.when(ok & (op != "delete"), image("new", 1))))
    return outcomes.select(F.inline(images))


def moments(stats: DataFrame, shift: Mapping[str, float] | None = None) -> DataFrame:
    """Per class and pair, and over all classes (label ``all``): n, means, population covariance and correlation.

    The correlation is NULL where a feature is constant as far as the sums tell.
    """
    named = stats.withColumn("label", F.col("label").cast("string"))
    rows = named.unionByName(named.withColumn("label", F.lit("all")))
    whole = rows.groupBy(*KEYS).agg(*[F.sum(s).alias(s) for s in SUMS]).where(F.col("n") > 0)
    n = F.col("n")
    mean = {x: F.col(f"sum_{x}") / n for x in "fg"}
    cov = F.col("sum_fg") / n - mean["f"] * mean["g"]
    square = {x: F.col(f"sum_{x}{x}") / n for x in "fg"}
    # A variance under the precision of the sums is none.
    var = {x: F.when(square[x] - mean[x] * mean[x] > square[x] * 1e-13, square[x] - mean[x] * mean[x]).otherwise(F.lit(0.0)) for x in "fg"}
    back = {x: F.coalesce(F.element_at(F.create_map(*[F.lit(v) for kv in shift.items() for v in kv]), F.col(x)), F.lit(0.0)) if shift else F.lit(0.0) for x in "fg"}
    return whole.select(
        *KEYS, n.cast("long").alias("n"), (mean["f"] + back["f"]).alias("mean_f"), (mean["g"] + back["g"]).alias("mean_g"), cov.alias("covariance"),
        (cov / F.nullif(F.sqrt(var["f"]) * F.sqrt(var["g"]), F.lit(0.0))).alias("r"),
    )
