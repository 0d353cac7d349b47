"""Every registered query against its SQL at a small scale factor (ORACLE_SF_DIR picks another)."""

import os

import pytest

from tablewright.plans import registry
from tests.oracle import compare, duck

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, SF_DIR, QUERIES[name], SQL.get(name)) == ""


def test_sql_only_for_registered_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["ref", "n_name", "total_sales"]
