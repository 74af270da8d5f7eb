"""Exact order statistics, percentiles and row numbering without a global sort.

The percentile aggregate keeps every distinct value of a group in one buffer,
and a row number over a whole class keeps the class in one task. Here ranks are
found by counting, at every size: each pass counts the rows per value cell between known limits, picks the cell
that holds the wanted rank, and the next pass looks inside that cell only. A
pass moves at most ``CELLS`` counts per wanted rank (``FINE_ROWS`` in the last one).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeline.sources.stage import stage

CELLS = 4096
FINE_ROWS = 100_000


@dataclass(frozen=True)
class Ranked:
    """Value at a rank, with the number of rows below it and equal to it."""

    value: float
    below: int
    equal: int


def long_form(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """One row per (feature, value), with the ``keep`` columns; NULL and NaN values are left out."""
    cells = [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols
    ]
    return (
        df.select(*keep, F.explode(F.array(*cells)).alias("cell"))
        .select(*keep, "cell.feature", "cell.value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
    )


def rows_inside(df: DataFrame, cols: Sequence[str]) -> Callable[[Sequence[tuple]], DataFrame]:
    """Long rows of ``df`` that can lie in given (feature, low, high, ...) spans.

    The spans are literals on the columns themselves, so later passes read only
    the columns still searched, and files skip row groups outside the spans.
    """

    def inside(spans: Sequence[tuple]) -> DataFrame:
        tests = [F.col(span[0]).cast("double").between(span[1], span[2]) for span in spans]
        open_cols = [c for c in cols if any(span[0] == c for span in spans)]
        return long_form(df.where(reduce(or_, tests)), open_cols)

    return inside


def group_sizes(rows: DataFrame) -> dict[str, tuple[int, float, float]]:
    """Row count, smallest and largest value of each group of (feature, value) rows."""
    stats = rows.groupBy("feature").agg(
        F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )
    return {r["feature"]: (r["n"], r["lo"], r["hi"]) for r in stats.collect()}


def column_sizes(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[int, float, float]]:
    """The same for whole columns, in one aggregate; NULL and NaN do not count, empty columns are left out."""
    aggs = []
    for c in cols:
        v = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        aggs += [F.count(v).alias(f"{c}__n"), F.min(v).alias(f"{c}__lo"), F.max(v).alias(f"{c}__hi")]
    row = df.agg(*aggs).first()
    return {c: (row[f"{c}__n"], row[f"{c}__lo"], row[f"{c}__hi"]) for c in cols if row[f"{c}__n"]}


def order_statistics(
    rows: DataFrame,
    wanted: Mapping[str, Sequence[int]],
    sizes: Mapping[str, tuple[int, float, float]] | None = None,
    limits: Mapping[tuple[str, int], tuple[float, float, int, int]] | None = None,
    inside: Callable[[Sequence[tuple]], DataFrame] | None = None,
    cells: int = CELLS,
    fine_rows: int = FINE_ROWS,
) -> dict[tuple[str, int], Ranked]:
    """Exact values at zero-based ranks.

    ``rows`` has the columns feature (a group name) and value (double, neither
    NULL nor NaN). ``wanted`` gives the ranks per group. The driver holds one
    entry per wanted rank. Where the caller already knows limits of a rank's
    value (lowest, highest, rows below, rows inside), the search starts there.
    ``inside`` gives the rows of some spans where that is cheaper than all rows.
    """
    spark = rows.sparkSession
    found: dict[tuple[str, int], Ranked] = {}
    open_ranks: dict[tuple[str, int], tuple[float, float, int, int]] = {}
    if limits is None:
        sizes = sizes or group_sizes(rows)
        limits = {}
        for feature, ranks in wanted.items():
            n, lo, hi = sizes[feature]
            for rank in ranks:
                if not 0 <= rank < n:
                    raise ValueError(f"rank {rank} is outside the {n} rows of {feature!r}")
                limits[feature, rank] = (lo, hi, 0, n)
    for key, (lo, hi, below, n) in limits.items():
        if lo == hi:
            found[key] = Ranked(lo, below, n)
        else:
            open_ranks[key] = (lo, hi, below, n)
    while open_ranks:
        spans = sorted({(f, lo, hi, below, m <= fine_rows)
                        for (f, _), (lo, hi, below, m) in open_ranks.items()})
        number = {span[:3]: i for i, span in enumerate(spans)}
        limit_df = spark.createDataFrame(
            [(i, *span) for i, span in enumerate(spans)],
            "limit_id int, feature string, lo double, hi double, below long, fine boolean",
        )
        rank_df = spark.createDataFrame(
            [(number[f, lo, hi], f, r) for (f, r), (lo, hi, _, _) in open_ranks.items()],
            "limit_id int, feature string, rank long",
        )
        within = inside(spans) if inside else rows
        before = dict(open_ranks)
        for row in _count_cells(within, limit_df, rank_df, cells).collect():
            key = (row["feature"], row["rank"])
            if row["lo"] == row["hi"]:
                found[key] = Ranked(row["lo"], row["below"], row["n"])
                del open_ranks[key]
            else:
                open_ranks[key] = (row["lo"], row["hi"], row["below"], row["n"])
        if open_ranks == before:
            raise ValueError(f"no rows at the wanted ranks of {sorted({f for f, _ in open_ranks})}")
    return found


def _count_cells(
    rows: DataFrame, limits: DataFrame, ranks: DataFrame, cells: int
) -> DataFrame:
    """The cell of each wanted rank: its value limits, its row count and the rows below it."""
    v, lo, hi = F.col("value"), F.col("lo"), F.col("hi")
    # Halves keep the width finite; the end values get cells of their own, so a
    # pass always narrows, also for infinite limits and for one very frequent value.
    share = (v / 2 - lo / 2) / F.nullif(hi / 2 - lo / 2, F.lit(0.0))
    inner = F.floor(F.coalesce(F.nanvl(share, F.lit(0.0)), F.lit(0.0)) * (cells - 2)) + 1
    inner = F.least(F.greatest(inner, F.lit(1)), F.lit(cells - 2)).cast("double")
    cell = (
        F.when(F.col("fine"), v)
        .when(v == lo, F.lit(0.0))
        .when(v == hi, F.lit(float(cells - 1)))
        .otherwise(inner)
    )
    counted = (
        rows.join(F.broadcast(limits), "feature")
        .where((v >= lo) & (v <= hi))
        .groupBy("limit_id", cell.alias("cell"))
        .agg(
            F.count("*").alias("n"),
            F.min("value").alias("lo"),
            F.max("value").alias("hi"),
            F.first("below").alias("base"),
        )
    )
    before = Window.partitionBy("limit_id").orderBy("cell").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = counted.withColumn(
        "below", F.col("base") + F.coalesce(F.sum("n").over(before), F.lit(0))
    )
    inside = (F.col("rank") >= F.col("below")) & (F.col("rank") < F.col("below") + F.col("n"))
    return (
        placed.join(F.broadcast(ranks), "limit_id")
        .where(inside)
        .select("feature", "rank", "lo", "hi", "below", "n")
    )


def exact_percentiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    sizes: Mapping[str, tuple[int, float, float]] | None = None,
    fine_rows: int = FINE_ROWS,
) -> dict[str, list[float | None]]:
    """Linearly interpolated percentiles of each column, exact at any size; None for a column without values.

    ``sizes`` are the counts and limits of ``column_sizes``, for callers that have them. Between two
    neighbours the value is their weighted sum, so an infinite neighbour gives an infinite percentile.
    A span of at most ``fine_rows`` rows is counted value by value.
    """
    sizes = column_sizes(df, cols) if sizes is None else sizes
    places = {c: [(p * (sizes[c][0] - 1)) for p in probs] for c in cols if c in sizes}
    wanted = {
        c: sorted({r for x in at for r in (int(x), min(int(x) + 1, sizes[c][0] - 1))})
        for c, at in places.items()
    }
    values = {}
    if wanted:
        values = order_statistics(long_form(df, list(wanted)), wanted, sizes, inside=rows_inside(df, list(wanted)), fine_rows=fine_rows)

    def between(c: str, x: float) -> float:
        low = values[c, int(x)].value
        high = values[c, min(int(x) + 1, sizes[c][0] - 1)].value
        return low if low == high or x == int(x) else low * (int(x) + 1 - x) + high * (x - int(x))

    return {c: [between(c, x) for x in places[c]] if c in places else [None] * len(probs)
            for c in cols}


def values_at(df: DataFrame, col: str, ranks: Sequence[int]) -> dict[int, tuple]:
    """(value, rows before it) at zero-based ranks in ascending order, for any type that can be ordered.

    NaN comes behind the numbers and NULL last. Equal values are counted before
    they move; the counts are range-partitioned and only the ranges that hold a
    wanted rank are read again.
    """
    order = F.col("v").asc_nulls_last()
    counted = df.groupBy(F.col(col).alias("v")).agg(F.count("*").alias("n"))
    ranged = stage(counted.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "ids")
    totals = ranged.groupBy("_range").agg(F.sum("n").alias("n")).orderBy("_range").collect()
    starts, at = {}, 0
    for row in totals:
        inside = [r for r in ranks if at <= r < at + row["n"]]
        if inside:
            starts[row["_range"]] = (at, inside)
        at += row["n"]
    found = {}
    before = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.where(F.col("_range").isin(list(starts))).withColumn(
        "before", F.coalesce(F.sum("n").over(before), F.lit(0))
    )
    tests = [
        (F.col("_range") == k) & (F.col("before") <= r - at) & (F.col("before") + F.col("n") > r - at)
        for k, (at, inside) in starts.items() for r in inside
    ]
    if tests:
        for row in placed.where(reduce(or_, tests)).collect():
            at, inside = starts[row["_range"]]
            found |= {r: (row["v"], at + row["before"]) for r in inside
                      if row["before"] <= r - at < row["before"] + row["n"]}
    return found


def number_rows(df: DataFrame, order_by: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """Add consecutive numbers from ``start`` in the given order.

    The rows are range-partitioned and written once, so the partition of a row
    is fixed; each partition numbers its own rows behind the count of the
    partitions before it. Only the partition counts meet in one place.
    """
    ranged = df.repartitionByRange(*order_by).withColumn("_range", F.spark_partition_id())
    fixed = stage(ranged, "numbered")
    all_before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        fixed.groupBy("_range")
        .agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(all_before), F.lit(0)).alias("_offset"))
    )
    here = Window.partitionBy("_range").orderBy(*order_by)
    return (
        fixed.join(offsets, "_range")
        .withColumn(name, F.row_number().over(here) - 1 + F.col("_offset") + F.lit(start))
        .drop("_range", "_offset")
    )
