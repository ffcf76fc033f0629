"""Every registered query against its SQL on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as entry
from siftgate.checks.registry import CHECKS

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_of_the_library_has_sql():
    assert set(CHECKS) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    difference, _ = oracle.compare(spark, con, QUERIES[name], SQL[name], SF_DIR)
    assert difference is None, difference
