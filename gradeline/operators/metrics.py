"""Classification metrics from counts of (label, prediction)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLASSES = (0, 1)


def confusion(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per label and prediction (per model, when ``by`` names it)."""
    return df.groupBy(
        *by, F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    ).agg(F.count("*").alias("n"))


def accuracy(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose prediction equals the label."""
    hit = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    return counts.groupBy(*by).agg(
        F.sum("n").alias("n"), (hit / F.nullif(F.sum("n"), F.lit(0))).alias("accuracy")
    )


def class_report(
    counts: DataFrame, by: Sequence[str] = (), classes: Sequence[int] = CLASSES
) -> DataFrame:
    """Precision, recall, f1 and support per class with macro and weighted averages, as rows.

    A ratio without rows is 0, and so is the support of an absent class.
    """
    n = F.col("n")
    sums: list[Column] = []
    for c in classes:
        is_label, is_pred = F.col("label") == c, F.col("prediction") == c
        for name, test in (("hit", is_label & is_pred), ("label", is_label), ("pred", is_pred)):
            sums.append(F.sum(F.when(test, n).otherwise(0)).cast("double").alias(f"{name}_{c}"))
    per_model = counts.groupBy(*by).agg(F.sum("n").cast("double").alias("total"), *sums)

    def ratio(a: Column, b: Column) -> Column:
        return F.coalesce(a / F.nullif(b, F.lit(0.0)), F.lit(0.0))

    rows: list[Column] = []
    metrics: dict[str, list[Column]] = {"precision": [], "recall": [], "f1": []}

    def entry(cls: str, metric: str, value: Column) -> None:
        rows.append(F.struct(
            F.lit(cls).alias("class"), F.lit(metric).alias("metric"), value.alias("value")
        ))

    for c in classes:
        hit, label, pred = F.col(f"hit_{c}"), F.col(f"label_{c}"), F.col(f"pred_{c}")
        precision, recall = ratio(hit, pred), ratio(hit, label)
        f1 = ratio(2 * precision * recall, precision + recall)
        for name, value in zip(metrics, (precision, recall, f1)):
            metrics[name].append(value)
            entry(str(c), name, value)
        entry(str(c), "support", label)
    for name, values in metrics.items():
        entry("macro avg", name, sum(values[1:], values[0]) / len(classes))
        weighted = [v * F.col(f"label_{c}") for v, c in zip(values, classes)]
        entry("weighted avg", name, ratio(sum(weighted[1:], weighted[0]), F.col("total")))
    for name in ("macro avg", "weighted avg"):
        entry(name, "support", F.col("total"))
    hits = [F.col(f"hit_{c}") for c in classes]
    entry("all", "accuracy", ratio(sum(hits[1:], hits[0]), F.col("total")))
    return per_model.select(*by, F.explode(F.array(*rows)).alias("entry")).select(*by, "entry.*")
