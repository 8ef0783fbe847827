"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import differences, open_tables
from demandmill.plans import catalog, oracle

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def tables(sf):
    return open_tables(sf)


def test_every_demand_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.ORACLES)
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(SQL))
def test_query(spark, sf, tables, name):
    assert differences(QUERIES[name](spark, sf), tables, SQL[name]) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "View"
