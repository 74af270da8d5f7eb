"""Registered queries of the training-data operators on the smallest tables, against their DuckDB twins."""

from __future__ import annotations

import pytest

from gradeline.llm.oracles import ORACLES
from gradeline.llm.queries import QUERIES
from tests.compare import duck, rows_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_twin(spark, name):
    got, want = QUERIES[name](spark, SF_DIR).toPandas(), duck(SF_DIR).execute(ORACLES[name]).df()
    for c in got.columns:  # a long column with nulls comes from Spark as floats
        if str(want[c].dtype) == "Int64":
            got[c] = got[c].astype("Int64")
    assert sorted(got.columns) == sorted(want.columns) and rows_of(got) == rows_of(want)


def test_all_operators_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
