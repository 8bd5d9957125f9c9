"""Every registered query against DuckDB on the smallest tables, and the contract."""

import pytest
from oracle import connect, differences

import __spark_entry__ as entry_module

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, sf, name):
    got = QUERIES[name](spark, sf).toPandas()
    assert differences(got, con.execute(ORACLES[name]).df()) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0
