"""Every registered query against its SQL counterpart, on the small tables."""

import pytest

import __spark_entry__ as contract
from feedloom.plans.oracles import ORACLES
from feedloom.plans.registry import QUERIES
from oracle_check import database, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(contract.queries()[name](spark, SF_DIR), con, contract.oracle_sql()[name]) is None


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 5 and [r.distance for r in rows] == sorted(r.distance for r in rows)
