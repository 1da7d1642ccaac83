"""Every named query against its DuckDB oracle on the sf0.001 tables (columns, types and the
rows as multisets)."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import compare, connect  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from zonepulse.plans.catalog import QUERIES  # noqa: E402
from zonepulse.plans.oracle_sql import oracle_sql  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(E.queries()) and set(oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, scratch, name):
    assert compare(duck, QUERIES[name](spark, SF), oracle_sql()[name], scratch) == []


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "is_underserved" in df.columns
