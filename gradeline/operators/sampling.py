"""Exact, repeatable row sampling: class balancing and stratified splits.

A row is drawn by a hash of the seed and its key, so a sample depends neither
on the partitioning nor on the run. "The k rows with the lowest hash" becomes
a filter on the k-th lowest hash, which is found by counting; no class is
sorted or gathered anywhere.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeline.functions.columns import HASH_DIGITS, sample_hash
from gradeline.operators.profile import class_balance
from gradeline.operators.ranks import number_rows, order_statistics
from gradeline.sources.stage import stage

# Share of the smallest class, test share and seed.
MIN_RATIO = 0.4
TEST_SIZE = 0.3
SEED = 42

DRAW_CELLS = 1024
DRAW_SPAN = float(16**HASH_DIGITS)

Limits = tuple[float, float, int, int]


def draw_cells(
    df: DataFrame, label_col: str, key_cols: Sequence[str], seed: int
) -> dict[Any, list[tuple[int, float, float]]]:
    """Per label, the rows and the draw limits of each cell of the draw, in order.

    One pass gives the class sizes and the first step towards any cut. The
    driver holds ``DRAW_CELLS`` counts per class.
    """
    draw = sample_hash(seed, *[F.col(k) for k in key_cols])
    rows = df.select(F.col(label_col).alias("label"), draw.alias("draw"))
    cell = F.floor(F.col("draw") / F.lit(DRAW_SPAN / DRAW_CELLS))
    counted = rows.where(F.col("label").isNotNull()).groupBy("label", cell.alias("cell")).agg(
        F.count("*").alias("n"), F.min("draw").alias("lo"), F.max("draw").alias("hi")
    )
    cells: dict[Any, list[tuple[int, float, float]]] = {}
    for r in sorted(counted.collect(), key=lambda r: r["cell"]):
        cells.setdefault(r["label"], []).append((r["n"], r["lo"], r["hi"]))
    return cells


def _cell_of(cells: Sequence[tuple[int, float, float]], rank: int) -> Limits:
    below = 0
    for n, lo, hi in cells:
        if rank < below + n:
            return lo, hi, below, n
        below += n
    raise ValueError(f"rank {rank} is outside the {below} rows")


def _text(label: Any) -> str:
    """The text that Spark casts a label to."""
    return str(label).lower() if isinstance(label, bool) else str(label)


def mark_picks(
    df: DataFrame,
    label_col: str,
    key_cols: Sequence[str],
    takes: Mapping[Any, int],
    sizes: Mapping[Any, int],
    seed: int,
    name: str = "picked",
    cells: Mapping[Any, Sequence[tuple[int, float, float]]] | None = None,
) -> DataFrame:
    """Add a flag that is true for exactly ``takes[label]`` rows of each label.

    Rows that share the hash at the cut are numbered by key among themselves,
    which also settles copies of one key.
    """
    df = df.withColumn("_draw", sample_hash(seed, *[F.col(k) for k in key_cols]))
    draw, group = F.col("_draw"), F.col(label_col).cast("string")
    wanted = {_text(c): [k - 1] for c, k in takes.items() if 0 < k < sizes[c]}
    picked = F.lit(False)
    for c, k in takes.items():
        if k >= sizes[c]:
            picked = F.when(group == _text(c), True).otherwise(picked)
    if not wanted:
        return df.withColumn(name, picked).drop("_draw")
    rows = df.where(group.isin(list(wanted))).select(
        group.alias("feature"), draw.alias("value")
    )
    limits = None if cells is None else {
        (_text(c), k - 1): _cell_of(cells[c], k - 1)
        for c, k in takes.items() if _text(c) in wanted
    }
    cuts = order_statistics(
        rows, wanted, {_text(c): (n, 0.0, DRAW_SPAN) for c, n in sizes.items()}, limits
    )
    split_ties = F.lit(False)
    left_over: dict[str, int] = {}
    for (c, rank), cut in cuts.items():
        here = group == c
        whole = cut.below + cut.equal == rank + 1
        picked = F.when(
            here, draw <= F.lit(cut.value) if whole else draw < F.lit(cut.value)
        ).otherwise(picked)
        if not whole:
            split_ties = split_ties | (here & (draw == F.lit(cut.value)))
            left_over[c] = rank + 1 - cut.below
    if not left_over:
        return df.withColumn(name, picked).drop("_draw")
    clear = df.where(~F.coalesce(split_ties, F.lit(False))).withColumn(name, picked)
    tied = stage(df.where(split_ties).withColumn("_row", F.monotonically_increasing_id()))
    for c, k in left_over.items():
        numbered = number_rows(tied.where(group == c), [*key_cols, "_row"], "_place")
        settled = numbered.withColumn(name, F.col("_place") < k).drop("_row", "_place")
        clear = clear.unionByName(settled)
    return clear.drop("_draw")


def balance_classes(
    df: DataFrame,
    label_col: str,
    key_cols: Sequence[str],
    min_ratio: float = MIN_RATIO,
    seed: int = SEED,
) -> DataFrame:
    """Bring the smallest class to ``min_ratio`` by thinning the largest class, or by repeating the smallest.

    With more than two classes only the largest and the smallest one remain.
    One class, or a balanced table, comes back unchanged.
    """
    b = class_balance(df, label_col).first()
    if b["n_classes"] <= 1 or b["minority_ratio"] >= min_ratio:
        return df
    big, small = b["majority"], b["minority"]
    n_big, n_small = b["n_majority"], b["n_minority"]
    label = F.col(label_col)
    needed = int(n_small * (1 - min_ratio) / min_ratio)
    if needed <= n_big:
        rows = df.where(label.isin(big, small))
        takes, sizes = {big: needed, small: n_small}, {big: n_big, small: n_small}
        marked = mark_picks(rows, label_col, key_cols, takes, sizes, seed)
        return marked.where("picked").drop("picked")
    n_draws = int(n_big * min_ratio / (1 - min_ratio))
    repeated = draw_with_replacement(df.where(label == small), n_small, n_draws, key_cols, seed)
    return df.where(label == big).unionByName(repeated)


def draw_with_replacement(
    df: DataFrame, n_rows: int, n_draws: int, key_cols: Sequence[str], seed: int
) -> DataFrame:
    """``n_draws`` rows, each drawn from all ``n_rows`` rows alike."""
    # The fixed row id lets copies of one key spread over several ranges.
    fixed = stage(df.withColumn("_row", F.monotonically_increasing_id()))
    numbered = number_rows(fixed, [*key_cols, "_row"], "_place").drop("_row")
    draw = sample_hash(seed, F.col("id")) / F.lit(DRAW_SPAN)
    hits = (
        df.sparkSession.range(n_draws)
        .select(F.floor(draw * n_rows).alias("_place"))
        .groupBy("_place")
        .agg(F.count("*").cast("int").alias("_times"))
    )
    return (
        numbered.join(hits, "_place")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
        .drop("_place", "_times", "_copy")
    )


def test_sizes(counts: Mapping[Any, int], test_size: float) -> dict[Any, int]:
    """Test rows per class: proportional shares of the rounded-up total, by largest remainder."""
    total = sum(counts.values())
    n_test = math.ceil(total * test_size)
    floors = {c: n * n_test // total for c, n in counts.items()}
    rest = sorted(counts, key=lambda c: (-(counts[c] * n_test % total), c))
    extra = rest[: n_test - sum(floors.values())]
    return {c: n + (c in extra) for c, n in floors.items()}


test_sizes.__test__ = False  # not a test case


def stratified_split(
    df: DataFrame,
    label_col: str,
    key_cols: Sequence[str],
    test_size: float = TEST_SIZE,
    seed: int = SEED,
) -> DataFrame:
    """Add ``is_test``: the same share of every class, exact to the row."""
    cells = draw_cells(df, label_col, key_cols, seed)
    counts = {c: sum(n for n, _, _ in of_class) for c, of_class in cells.items()}
    takes = test_sizes(counts, test_size)
    return mark_picks(df, label_col, key_cols, takes, counts, seed, "is_test", cells)
