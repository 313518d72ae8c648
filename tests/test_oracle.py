"""Every registered query against its SQL, on the smallest data set."""

import os

import pytest
from oracle_check import compare, connect

import __spark_entry__ as contract
from textledger.plans import oracle, registry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@needs_data
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    problem, rows = compare(spark, con, name, contract.queries()[name], contract.oracle_sql()[name], SF_DIR)
    assert problem is None
    assert rows > 0


@needs_data
def test_entry(spark):
    assert contract.entry(spark).count() > 0
