"""Every registered query against its DuckDB counterpart on the smallest data."""

import pytest

import __spark_entry__ as contract
from check_oracles import compare, connect
from conftest import SMALL
from desklake.oracle import ORACLE_SQL
from desklake.plans import registry


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(registry.queries()))
def test_equal(spark, connection, name):
    assert compare(spark, connection, SMALL, name) is None


def test_contract(spark):
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(registry.queries()) == set(ORACLE_SQL)
