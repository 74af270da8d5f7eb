"""The composed results fit together."""

from __future__ import annotations

import random

from gradeline.config import TableSpec
from gradeline.plans import reports

SPEC = TableSpec("id", ("x", "y"), "quality")


def test_overview_charts_and_insights(spark):
    rng = random.Random(3)
    data = []
    for i in range(300):
        x = rng.gauss(0, 1)
        data.append((i, x, None if i % 50 == 0 else rng.gauss(0, 1), "good" if x > 0 else "Bad"))
    df = spark.createDataFrame(data, "id long, x double, y double, quality string")
    seen = reports.data_overview(df, SPEC, page=2, limit=25)
    assert [r["id"] for r in seen["page"].collect()] == list(range(10, 20))
    assert {r["feature"]: r["count"] for r in seen["summary"].collect()} == {"id": 25, "x": 25, "y": 24}
    charts = reports.chart_data(df, SPEC)
    assert charts["matrix"].count() == 9
    assert sum(r["n"] for r in charts["classes"].collect()) == 294
    found = reports.insights(charts, documented_bands=True)
    assert found["importance"].first()["feature"] == "x"
    assert found["importance"].first()["role"] == "control"
    assert [r["feature"] for r in found["differences"].collect()] == ["x"]
    assert found["bands"].first()["strength"] == "strong"
    assert found["top_bins"].count() == 6
