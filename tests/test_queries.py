"""Every registered query on the smallest test tables, against its DuckDB twin where there is one."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from gradeline.plans import registry
from tests.compare import duck, rows_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The optional queries have tests of their own.
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


def test_driver_lists_every_query():
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() == 4


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_twin(spark, con, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)
