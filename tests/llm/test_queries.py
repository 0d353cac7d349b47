"""Every registered query of the package against its SQL and against plain Python, on a whole small table set."""

import os

import pytest

from tablewright.llm import queries
from tests.llm.compare import COLUMNS, differences
from tests.oracle import compare, duck

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = queries.queries(), queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, duck(SF_DIR), name, SF_DIR, QUERIES[name], SQL.get(name)) == ""


@pytest.mark.parametrize("op", sorted(COLUMNS))
def test_query_equals_plain_python(spark, op):
    more, less, n = differences(spark, SF_DIR, op)
    assert not more and not less and n


def test_all_are_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
