"""Every registered query against its DuckDB form."""

import pytest
from oracle_check import compare, duck

import __spark_entry__ as entry
from oracles import all_sql
from quayside.plans.catalog import all_queries

QUERIES, SQL = all_queries(), all_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


def test_names_match():
    assert set(SQL) <= set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries()) >= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf, name):
    if name in SQL:
        assert compare(spark, con, QUERIES[name], SQL[name], sf) is None
    else:
        assert QUERIES[name](spark, sf).count() > 0


def test_entry_has_stable_columns(spark):
    df = entry.entry(spark)
    assert df.columns == ["trade_date", "exports", "imports", "flow", "balance"]
    assert df.count() > 0
