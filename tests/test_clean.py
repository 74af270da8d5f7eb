"""Cleaning, profiles and relations on small literal frames."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gradeline.config import TableSpec
from gradeline.functions import columns as C
from gradeline.operators import clean, profile, relate

NAN = float("nan")
SPEC = TableSpec("id", ("x", "y"), "quality")


def values(df, col):
    return [r[col] for r in df.collect()]


@pytest.mark.parametrize("text,number", [
    ("1", 1.0), (" 2.5 ", 2.5), ("1e3", 1000.0), ("-.5", -0.5), ("inf", math.inf), ("1.5d", None),
    ("n/a", None), ("", None), (None, None), ("nan", None), ("0x1F", None),
])
def test_numbers_from_text(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert values(df.select(C.to_number(F.col("t")).alias("n")), "n") == [number]
    assert values(df.select(C.number_or_default(F.col("t")).alias("n")), "n") == [number or 0.0]


def test_labels_in_any_spelling(spark):
    texts = ["good", "BAD", "True", "false", "1", "0", " good", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "q string")
    assert values(clean.map_labels(df, "q", SPEC.label_map), "q") == [1, 0, 1, 0, 1, 0]


def test_cleaning_keeps_rows_that_differ_in_id_only(spark):
    data = [
        (1, "1", 1.0, "good"), (1, "1", 1.0, "good"), (2, "1", 1.0, "good"), (3, "x", 1.0, "bad"),
        (4, "2", NAN, "bad"), (5, "2", 2.0, "odd"), (6, None, 2.0, "bad"), (7, "2", 2.0, "BAD"),
    ]
    df = spark.createDataFrame(data, "id long, x string, y double, quality string")
    got = clean.clean(df, SPEC)
    assert got.columns == ["x", "y", "quality"]
    assert sorted(map(tuple, got.collect())) == [(1.0, 1.0, 1), (1.0, 1.0, 1), (2.0, 2.0, 0)]


def test_row_filters_run_before_the_duplicate_shuffle(spark):
    df = spark.createDataFrame([(1, "1", 1.0, "good")], "id long, x string, y double, quality string")
    plan = clean.clean(df, SPEC)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    first_filter = min(i for i, line in enumerate(lines) if "Filter" in line)
    aggregate = min(i for i, line in enumerate(lines) if "Aggregate" in line)
    assert aggregate < first_filter  # the filter is below, that is, before the aggregate


def sequential(pdf, cols):
    for c in cols:
        q1, q3 = pdf[c].quantile(0.25), pdf[c].quantile(0.75)
        pdf = pdf[(pdf[c] >= q1 - 1.5 * (q3 - q1)) & (pdf[c] <= q3 + 1.5 * (q3 - q1))]
    return pdf


@pytest.mark.parametrize("staged", [True, False])
def test_outliers_column_after_column(spark, staged):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"x": rng.standard_t(2, 500), "y": rng.standard_t(1, 500)})
    pdf["quality"] = (rng.random(500) < 0.85).astype(int)
    df = spark.createDataFrame(pdf)
    got = clean.remove_outliers(df, SPEC, staged=staged).toPandas().sort_values(["x", "y"])
    want = sequential(pdf, ["x", "y"]).sort_values(["x", "y"])
    assert np.array_equal(got.to_numpy(), want.to_numpy())
    # With the label included, the quartiles of an 85 % class delete the other class.
    both = clean.remove_outliers(df, SPEC, include_label=True, staged=staged)
    assert values(both.select("quality").distinct(), "quality") == [1]


def searched(monkeypatch):
    """The columns of each search for outlier limits."""
    calls, search = [], clean.iqr_bounds
    monkeypatch.setattr(clean, "iqr_bounds", lambda df, cols, *args: calls.append(list(cols)) or search(df, cols, *args))
    return calls


def test_columns_without_outliers_are_searched_together(spark, monkeypatch):
    calls, names = searched(monkeypatch), ("a", "b", "c", "d")
    df = spark.range(200).select(*[((F.col("id") * k) % 200).cast("double").alias(c) for k, c in zip((3, 7, 9, 11), names)])
    got = clean.remove_outliers(df, TableSpec("id", names, "quality"))
    assert got.count() == 200 and calls == [list(names)]


@pytest.mark.parametrize("odd,missing", [("", "bf"), ("a", "d"), ("abcdef", ""), ("be", "a")])
def test_columns_searched_together_equal_one_after_another(spark, monkeypatch, odd, missing):
    calls, names, rng = searched(monkeypatch), list("abcdef"), np.random.default_rng(len(odd) + 10 * len(missing))
    pdf = pd.DataFrame({c: rng.standard_t(1, 400) if c in odd else rng.random(400) for c in names})
    for c in missing:
        pdf.loc[rng.integers(0, 400, 9), c] = np.nan  # a missing value goes with its row, at that column's turn
    # The last columns follow the first one, so that rows dropped there move their quartiles.
    pdf["f"] += pdf["a"].fillna(0).clip(-50, 50)
    rows = pdf.astype(object).where(pdf.notna() | (pdf.index.to_numpy() % 2 == 0)[:, None], None)
    df = spark.createDataFrame(list(rows.itertuples(index=False, name=None)), ", ".join(f"{c} double" for c in names))
    got = clean.remove_outliers(df, TableSpec("id", tuple(names), "quality"), staged=False).toPandas().sort_values(names)
    assert np.array_equal(got.to_numpy(float), sequential(pdf, names).sort_values(names).to_numpy())
    assert calls[0] == names and len(calls) <= 6


def test_outliers_of_empty_and_of_missing_columns(spark):
    spec = TableSpec("id", ("x", "y"), "quality")
    assert clean.remove_outliers(spark.createDataFrame([], "x double, y double"), spec).count() == 0
    df = spark.createDataFrame([(1.0, NAN), (2.0, None), (3.0, NAN), (None, 1.0), (4.0, NAN)], "x double, y double")
    # The value that y has goes with the missing x; of the column left without values only NULL goes.
    assert sorted(r.x for r in clean.remove_outliers(df, spec).collect()) == [1.0, 3.0, 4.0]
    same = spark.createDataFrame([(5.0, 1.0)] * 9 + [(6.0, 1.0), (5.0, 2.0)], "x double, y double")
    assert sorted(map(tuple, clean.remove_outliers(same, spec).collect())) == [(5.0, 1.0)] * 9
    infinite = spark.createDataFrame([(math.inf, 1.0)] * 5 + [(1.0, 1.0)], "x double, y double")
    assert clean.remove_outliers(infinite, spec).count() == 0  # no distance between infinite quartiles


def test_text_column_is_left_alone_by_the_outlier_rule(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("b", 2.0, 1)], "x string, y double, quality int")
    assert clean.remove_outliers(df, SPEC).count() == 2


def test_describe_equals_pandas(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"x": rng.normal(size=101), "y": rng.integers(0, 5, 101).astype(float)})
    pdf.loc[3, "x"] = np.nan
    df = spark.createDataFrame(pdf)
    want = pdf.describe()
    got = profile.describe(df).toPandas().set_index("feature")
    for c in ("x", "y"):
        row = got.loc[c, ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]]
        assert row.to_numpy(float) == pytest.approx(want[c].to_numpy(), rel=1e-12)


def test_missing_values_and_column_stats(spark):
    df = spark.createDataFrame([(1.0, "a"), (NAN, "b"), (None, "a"), (2.0, None)], "x double, s string")
    assert {r["feature"]: r["missing"] for r in profile.missing_values(df).collect()} == {"x": 2, "s": 1}
    stats = {r["feature"]: r for r in profile.column_stats(df).collect()}
    assert (stats["x"]["distinct"], stats["x"]["min"], stats["x"]["max"]) == (3, 1.0, 2.0)
    assert (stats["s"]["distinct"], stats["s"]["is_numeric"], stats["s"]["dtype"]) == (3, False, "string")
    approx = {r["feature"]: r["distinct"] for r in profile.column_stats(df, approx=True).collect()}
    assert approx == {"x": 3, "s": 3}


def test_classes(spark):
    df = spark.createDataFrame([(1,)] * 6 + [(0,)] * 2 + [(2,)] * 2, "q int")
    row = profile.class_balance(df, "q").first()
    assert (row["majority"], row["minority"], row["minority_ratio"]) == (1, 2, 0.2)
    shares = {r["label"]: r["share"] for r in profile.class_share(df, "q").collect()}
    assert shares == {0: 20.0, 1: 60.0, 2: 20.0}


def test_histogram_is_a_density_per_class(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"x": rng.normal(size=300), "y": 3.0, "quality": rng.integers(0, 2, 300)})
    pdf.loc[:10, "x"] = np.nan
    hist = profile.histogram(spark.createDataFrame(pdf), ["x", "y"], "quality").toPandas()
    area = (hist["density"] * (hist["bin_end"] - hist["bin_start"])).groupby(
        [hist["feature"], hist["label"]]).sum()
    assert area.to_numpy() == pytest.approx(1.0)
    clean_x = pdf.dropna()
    edges = np.linspace(clean_x["x"].min(), clean_x["x"].max(), 21)
    for label in (0, 1):
        want, _ = np.histogram(clean_x.loc[clean_x["quality"] == label, "x"], edges)
        part = hist[(hist["feature"] == "x") & (hist["label"] == label)].set_index("bin")["n"]
        assert np.array_equal(part.reindex(range(20), fill_value=0).to_numpy(), want)
    top = profile.top_bins(profile.histogram(spark.createDataFrame(pdf), ["y"], "quality")).collect()
    assert [(r["bin"], r["n"]) for r in top] == [(0, 300)]


def test_correlations_equal_pandas_with_gaps_and_constants(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame(rng.normal(size=(200, 3)), columns=list("abc"))
    pdf["k"] = 1.0
    pdf.loc[::7, "a"] = np.nan
    pdf.loc[::5, "b"] = np.nan
    df = spark.createDataFrame(pdf)
    want = pdf.corr()
    for r in relate.corr_matrix(df, list("abck")).collect():
        w = want.loc[r["feature_a"], r["feature_b"]]
        assert (r["r"] is None and np.isnan(w)) or r["r"] == pytest.approx(w)
    found = {r["feature"]: r["r"] for r in relate.label_correlation(df, ["a", "k"], "c").collect()}
    assert found["a"] == pytest.approx(want.loc["a", "c"]) and found["k"] is None
    full = pdf[["c"]].assign(d=pdf["c"] * 2 + rng.normal(size=200))
    pair = relate.corr_matrix(spark.createDataFrame(full), ["c", "d"], complete=True).collect()
    assert {round(r["r"], 9) for r in pair} == set(np.round(full.corr().to_numpy().ravel(), 9))


def test_scaling_and_profile(spark):
    pdf = pd.DataFrame({"x": [1.0, 2.0, 3.0, 6.0], "y": [5.0] * 4, "quality": [0, 0, 1, 1]})
    df = spark.createDataFrame(pdf)
    z = relate.standardize(df, ["x", "y"]).toPandas()
    assert z["x"].mean() == pytest.approx(0) and z["x"].std(ddof=0) == pytest.approx(1)
    assert (z["y"] == 0).all()
    got = {r["feature"]: r for r in relate.class_profile(df, ["x", "y"], "quality").collect()}
    scaled = (z["x"] + 3) / 6 * 10
    assert got["x"]["high_quality"] == pytest.approx(scaled[2:].mean())
    assert got["x"]["difference"] == pytest.approx(scaled[2:].mean() - scaled[:2].mean())
    assert got["x"]["advantage"] == "good_higher" and got["x"]["significant"]
    assert got["y"]["advantage"] == "equal" and not got["y"]["significant"]
    # Other rows are scaled with the statistics of the training rows.
    stats = relate.scaler_stats(df, ["x"])
    other = relate.standardize(spark.createDataFrame([(3.0,)], "x double"), ["x"], stats).first()
    assert other["x"] == pytest.approx(0)


def test_bands_ranks_and_importance(spark):
    r = spark.createDataFrame(
        [("a", 0.7), ("b", -0.4), ("c", 0.2), ("d", -0.04), ("e", None)], "feature string, r double"
    )
    code = {x["feature"]: (x["strength"], x["direction"]) for x in relate.correlation_bands(r).collect()}
    assert code == {"a": ("strong", "positive"), "b": ("medium", "negative"),
                    "c": ("weak", "positive"), "d": ("weak", "negative"), "e": (None, None)}
    text = relate.correlation_bands(r, C.BANDS_TEXT, "very_weak")
    assert values(text, "strength") == ["strong", "strong", "medium", "very_weak", None]
    assert values(relate.correlation_rank(r), "feature") == ["a", "b", "c", "d", "e"]
    best = relate.correlation_extremes(r).first()
    assert (best["strongest_positive"], best["strongest_negative"], best["weakest"]) == ("a", "b", "d")
    none = relate.correlation_extremes(r.where("r > 0")).first()
    assert none["strongest_negative"] is None
    gaps = spark.createDataFrame([("a", 1.0), ("b", -0.5), ("c", 3.0)], "feature string, difference double")
    top = relate.feature_importance(r, gaps).collect()
    assert [(x["feature"], x["role"]) for x in top] == [
        ("a", "control"), ("c", "secondary"), ("b", "other")]


def test_text_helpers(spark):
    df = spark.createDataFrame([("a\x00b\tc\x7f\n", 'x<>:"/\\|?*  y' + "z" * 60)], "a string, b string")
    row = df.select(C.strip_control(F.col("a")).alias("a"), C.safe_name(F.col("b")).alias("b")).first()
    assert row["a"] == "ab\tc\n" and row["b"] == ("x_________" + "_y" + "z" * 60)[:50]
    keys = ["2025-01-05_11-22_Deep_Net", "2025-01-05_xx_N", "plain", "2025-01-05_11-22"]
    got = spark.createDataFrame([(k,) for k in keys], "k string").select(
        F.date_format(C.report_time(F.col("k")), "yyyy-MM-dd HH:mm").alias("t"),
        C.report_name(F.col("k")).alias("n")).collect()
    assert [tuple(r) for r in got] == [
        ("2025-01-05 11:22", "Deep Net"), (None, "unknown"), (None, "unknown"), (None, "unknown")]
    secrets = spark.createDataFrame([("sk-123456",), ("12345",), ("",), (None,)], "s string")
    assert values(secrets.select(C.mask_secret(F.col("s")).alias("m")), "m") == [
        "**********23456", "*****", "", ""]
    times = spark.createDataFrame(
        [("2024-01-02T03:04:05Z",), ("2024-01-02 03:04:05",), ("2024-01-02T03:04:05.250",), ("no",)], "t string")
    shown = values(times.select(C.parse_time(F.col("t")).cast("string").alias("t")), "t")
    assert shown == ["2024-01-02 03:04:05", "2024-01-02 03:04:05", "2024-01-02 03:04:05.25", None]
