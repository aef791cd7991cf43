"""Registered queries against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, CHECKS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_sql(spark, con, name):
    result = compare(spark, con, SF, name, QUERIES[name], CHECKS[name])
    assert result.startswith("match")


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)
