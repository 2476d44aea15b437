"""Every registered query against its SQL twin, on the smallest data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from panelprep.plans import registry
from tests.oracle_compare import compare, connect

SF_DIR, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_sql(spark, con, name):
    query, sql = entry.queries()[name], entry.oracle_sql()[name]
    problem = compare(spark, con, SF_DIR, query, sql)
    if problem == "no rows":  # too small to show anything
        problem = compare(spark, connect(LARGER), LARGER, query, sql)
    assert problem is None


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_entry(spark):
    out = entry.entry(spark)
    assert out.columns[:3] == ["index_code", "trade_date", "index_flow"]
    assert out.count() > 0
