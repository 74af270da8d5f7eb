"""The composed results: overview of a raw table, chart data and insights of a clean one."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gradeline.config import TableSpec
from gradeline.functions import columns as C
from gradeline.operators import listing, profile, relate
from gradeline.operators.clean import clean, nan_as_null
from gradeline.sources.stage import stage


def data_overview(
    df: DataFrame, spec: TableSpec, page: int = 1, limit: int | None = None
) -> dict[str, DataFrame]:
    """Summary, missing values and one page of a raw table, over its first ``limit`` rows."""
    rows = listing.limit_rows(nan_as_null(df), spec.id_col, limit)
    return {
        "summary": profile.describe(rows),
        "missing": profile.missing_values(rows),
        "page": listing.page_rows(df, spec.id_col, page, limit),
    }


def chart_data(df: DataFrame, spec: TableSpec, n_bins: int = profile.N_BINS) -> dict[str, DataFrame]:
    """Everything the charts show. The cleaned table is written once and scanned per chart."""
    rows, cols, label = stage(clean(df, spec), "cleaned"), list(spec.feature_cols), spec.label_col
    return {
        "correlations": relate.label_correlation(rows, cols, label),
        "matrix": relate.corr_matrix(rows, [*cols, label], complete=True),
        "profile": relate.class_profile(rows, cols, label),
        "classes": profile.class_counts(rows, label, cols),
        "shares": profile.class_share(rows, label),
        "histogram": profile.histogram(rows, cols, label, n_bins),
    }


def insights(charts: dict[str, DataFrame], documented_bands: bool = False) -> dict[str, DataFrame]:
    """Ranked findings from chart data: bands, extremes, class differences, full bins, importance."""
    r, profiles = charts["correlations"], charts["profile"]
    bands = (C.BANDS_TEXT, "very_weak") if documented_bands else (C.BANDS_CODE, "weak")
    return {
        "shares": charts["shares"],
        "bands": relate.correlation_bands(relate.correlation_rank(r), *bands),
        "extremes": relate.correlation_extremes(r),
        "differences": profiles.where("significant"),
        "top_bins": profile.top_bins(charts["histogram"]),
        "importance": relate.feature_importance(r, profiles),
    }
