"""Every registered relational query equals its DuckDB twin (sf0.001)."""

import pytest

import __spark_entry__ as entry
from oracle_util import compare, duck

from conftest import SF_SMALL

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    assert compare(df, SQL[name], SF_SMALL, digits=9, con=con) == []


def test_every_query_has_a_callable_and_entry_runs(spark):
    qs = entry.queries()
    assert set(SQL) <= set(qs)
    assert entry.entry(spark).count() > 0
