"""Cleaning: nulls, duplicates, types, labels, outliers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradeline.config import TableSpec
from gradeline.functions import columns as C
from gradeline.operators.ranks import FINE_ROWS, column_sizes, exact_percentiles
from gradeline.sources.stage import stage

# Quartiles and reach of the outlier rule.
QUARTILES = (0.25, 0.75)
IQR_REACH = 1.5

_EVERY_ROW = "_every_row"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def nan_as_null(df: DataFrame) -> DataFrame:
    """NaN sorts above every number in Spark; treat it as missing from the start."""
    floats = [c for c in df.columns if _is_float(df, c)]
    return df.withColumns({c: C.nan_to_null(F.col(c)) for c in floats}) if floats else df


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop the rows with a missing value in any column (of ``subset``)."""
    return nan_as_null(df).dropna(how="any", subset=list(subset) if subset else None)


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each set of rows equal in every column, the id included."""
    return df.dropDuplicates()


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text columns to double; unreadable text becomes NULL."""
    return df.withColumns({
        c: C.nan_to_null(F.col(c).cast("double"))
        if isinstance(df.schema[c].dataType, T.NumericType) else C.to_number(F.col(c))
        for c in cols
    })


def map_labels(df: DataFrame, label_col: str, label_map: Mapping[str, int]) -> DataFrame:
    """Label spellings to class codes; rows with an unknown spelling are dropped."""
    coded = df.withColumn(label_col, C.label_code(F.col(label_col), label_map))
    return coded.where(F.col(label_col).isNotNull())


def clean(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The cleaning chain: nulls, duplicates, id, types, labels, nulls again.

    One lazy plan. The row filters behind the duplicate step only look at the
    row itself, so Catalyst moves them in front of its shuffle.
    """
    present = [c for c in spec.feature_cols if c in df.columns]
    rows = drop_duplicates(drop_nulls(df))
    if spec.id_col:
        rows = rows.drop(spec.id_col)
    rows = coerce_numeric(rows, present)
    if spec.label_col in df.columns:
        rows = map_labels(rows, spec.label_col, spec.label_map)
    return drop_nulls(rows)


def numeric_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text columns of ``cols`` whose values are all numbers as doubles; one aggregate decides for all of them."""
    texts = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    if not texts:
        return df
    other = df.agg(*[F.count_if(F.col(c).isNotNull() & C.to_number(F.col(c)).isNull()).alias(c) for c in texts]).first()
    return df.withColumns({c: C.to_number(F.col(c)) for c in texts if other[c] == 0})


def iqr_bounds(
    df: DataFrame,
    cols: Sequence[str],
    sizes: Mapping[str, tuple[int, float, float]] | None = None,
    fine_rows: int = FINE_ROWS,
) -> dict[str, tuple[float, float, float, float] | None]:
    """Q1, Q3 and the outlier limits of each column; None for a column without values.

    ``sizes`` and ``fine_rows`` are those of ``exact_percentiles``.
    """
    quartiles = exact_percentiles(df, cols, QUARTILES, sizes, fine_rows)
    bounds = {}
    for c, (q1, q3) in quartiles.items():
        reach = None if q1 is None else IQR_REACH * (q3 - q1)
        bounds[c] = None if reach is None else (q1, q3, q1 - reach, q3 + reach)
    return bounds


def remove_outliers(
    df: DataFrame, spec: TableSpec, include_label: bool = False, staged: bool = True
) -> DataFrame:
    """Drop IQR outliers column by column, each on the rows the columns before it left.

    A column whose limits leave every row does not change what the next one is
    judged on, so columns are searched together: all of them at first, one after
    a column that did drop rows, then twice as many each time none did. The limits
    that drop rows are plain literals in the filter, so every pass is one scan with
    a pushed-down filter and nothing is cached.
    ``staged=True`` writes the input once, since it is read several times;
    pass False for a frame that is cheap to read again. A text column whose
    values are all numbers becomes one; a text column with any other value is
    left alone. ``include_label`` also filters the label.
    """
    names = [c for c in [*spec.feature_cols, *([spec.label_col] if include_label else [])] if c in df.columns]
    df = numeric_text(df, names)
    names = [c for c in names if c in numeric_columns(df)]
    rows = stage(df, "outliers") if staged else df
    ahead = len(names)
    while names:
        together = names[:ahead]
        # The constant counts the rows, with or without a value in the columns.
        sizes = column_sizes(rows.withColumn(_EVERY_ROW, F.lit(0.0)), [*together, _EVERY_ROW])
        n_rows = sizes[_EVERY_ROW][0] if _EVERY_ROW in sizes else 0
        # Searched together, the columns share the groups that a task may hold in the last pass.
        bounds = iqr_bounds(rows, together, sizes, FINE_ROWS // len(together))
        ahead *= 2
        for c in together:
            names = names[1:]
            if bounds[c] is None:
                return rows.where(F.col(c).isNotNull())
            n, lo, hi = sizes[c]
            _, _, lower, upper = bounds[c]
            if not (n == n_rows and lower <= lo and hi <= upper):
                rows = rows.where(F.col(c).between(lower, upper))
                ahead = 1
                break
    return rows
