"""Filtered, ordered and paged reads, and the probe for new rows."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeline.operators.ranks import number_rows, values_at

# Page sizes.
PAGE_ROWS = 10
LIST_ROWS = 20
TOP_ROWS = 100_000


def filter_rows(
    df: DataFrame,
    equals: Mapping[str, Any] | None = None,
    ranges: Mapping[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """Rows that meet all given conditions; None means no condition, 0 is a bound like any other."""
    tests = [F.col(c) == F.lit(v) for c, v in (equals or {}).items() if v is not None]
    for c, (low, high) in (ranges or {}).items():
        if low is not None:
            tests.append(F.col(c) >= F.lit(low))
        if high is not None:
            tests.append(F.col(c) <= F.lit(high))
    return df.where(reduce(and_, tests)) if tests else df


def slice_rows(
    df: DataFrame,
    id_col: str,
    offset: int,
    limit: int | None,
    ties: Sequence[str] | None = None,
    top_rows: int = TOP_ROWS,
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` in id order; ids of any type, NaN behind the numbers, NULL last.

    A top-k carries every row before its end to one task. Where these are more
    than ``top_rows``, the ids at both ends are found first and the slice
    becomes a range filter on the id, with the same rows in the same order.
    Rows of equal id are ordered by ``ties``, by default all other columns that
    have an order, so that either way takes the same ones.
    """
    if ties is None:
        ties = [f.name for f in df.schema if f.name != id_col and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = [F.col(id_col).asc_nulls_last(), *ties]
    if limit == 0:
        return df.limit(0)
    if limit is not None and offset + limit <= top_rows:
        return df.orderBy(*order).offset(offset).limit(limit)
    if limit is None and offset == 0:
        return df.orderBy(*order)
    v = F.col(id_col)
    ends = [offset] if limit is None else [offset, offset + limit - 1]
    found = values_at(df, id_col, ends)
    if offset not in found:
        return df.limit(0)
    first, before = found[offset]
    inside = df.where(v.isNull() if first is None else v.isNull() | (v >= F.lit(first)))
    if ends[-1] in found and limit is not None and found[ends[-1]][0] is not None:
        inside = inside.where(v <= F.lit(found[ends[-1]][0]))
    skip = offset - before
    if limit is not None and skip + limit <= top_rows:
        return inside.orderBy(*order).offset(skip).limit(limit)
    numbered = number_rows(inside, order, "_rank")
    taken = F.col("_rank") >= skip
    if limit is not None:
        taken &= F.col("_rank") < skip + limit
    return numbered.where(taken).orderBy("_rank").drop("_rank")


def list_rows(
    df: DataFrame,
    id_col: str,
    equals: Mapping[str, Any] | None = None,
    ranges: Mapping[str, tuple[float | None, float | None]] | None = None,
    limit: int | None = LIST_ROWS,
    offset: int = 0,
) -> DataFrame:
    """One page of the filtered rows in id order."""
    return slice_rows(filter_rows(df, equals, ranges), id_col, offset, limit)


def list_info(
    df: DataFrame,
    equals: Mapping[str, Any] | None = None,
    ranges: Mapping[str, tuple[float | None, float | None]] | None = None,
    limit: int = LIST_ROWS,
    offset: int = 0,
) -> DataFrame:
    """Total of the filtered rows and whether rows follow the page."""
    return filter_rows(df, equals, ranges).agg(F.count("*").alias("total")).select(
        "total", F.lit(limit).alias("limit"), F.lit(offset).alias("offset"),
        (F.lit(offset + limit) < F.col("total")).alias("has_more"),
    )


def limit_rows(df: DataFrame, id_col: str, limit: int | None) -> DataFrame:
    """The first rows by id, or all of them."""
    return df if limit is None else slice_rows(df, id_col, 0, limit)


def _page(total: int, page: int, per_page: int) -> tuple[int, int]:
    """The page that exists for a page number, and the number of pages (1 for an empty table)."""
    pages = max(math.ceil(total / per_page), 1)
    return min(max(page, 1), pages), pages


def page_rows(
    df: DataFrame,
    id_col: str,
    page: int,
    limit: int | None = None,
    per_page: int = PAGE_ROWS,
    top_rows: int = TOP_ROWS,
) -> DataFrame:
    """A page by number, of the first ``limit`` rows; a number past the end gives the last page."""
    total = df.count() if limit is None else min(df.count(), limit)
    offset = (_page(total, page, per_page)[0] - 1) * per_page
    return slice_rows(df, id_col, offset, max(min(per_page, total - offset), 0), top_rows=top_rows)


def page_info(df: DataFrame, page: int, limit: int | None = None, per_page: int = PAGE_ROWS) -> DataFrame:
    """Rows, page size, number of pages, and the page that ``page_rows`` gives for this number."""
    rows = F.count("*") if limit is None else F.least(F.count("*"), F.lit(limit).cast("long"))
    pages = F.greatest(F.ceil(F.col("total") / per_page), F.lit(1)).cast("long")
    return df.agg(rows.alias("total")).select(
        "total", F.lit(per_page).alias("per_page"), pages.alias("pages"),
        F.least(F.lit(max(page, 1)).cast("long"), pages).alias("page"),
    )


def update_probe(df: DataFrame, id_col: str, last_id: int | None) -> DataFrame:
    """Whether ids beyond ``last_id`` exist: the id gap and the true number of such rows."""
    if last_id is None:
        newer, gap = F.count_if(F.col(id_col).isNotNull()), F.when(F.col("max_id") > 0, 1)
        has_updates = F.col("max_id") > 0
    else:
        newer = F.count_if(F.col(id_col) > last_id)
        gap = F.when(F.col("max_id") > last_id, F.col("max_id") - last_id)
        has_updates = F.col("max_id") > last_id
    seen = df.agg(
        F.count("*").alias("total"), F.coalesce(F.max(id_col), F.lit(0)).alias("max_id"),
        newer.alias("rows_after"),
    )
    return seen.select(
        "total", "max_id", has_updates.alias("has_updates"),
        F.coalesce(gap, F.lit(0)).cast("long").alias("new_records"), "rows_after",
    )
