"""Every query of the library against its SQL."""

import pytest
from compare import connect, difference
from conftest import TESTDATA

import __spark_entry__ as entry
from culvert.plans.oracles import ORACLES
from culvert.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(f"{TESTDATA}/sf0.01")


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()


def test_the_entry_registers_every_query():
    assert QUERIES.keys() <= entry.queries().keys()
    assert ORACLES.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, f"{TESTDATA}/sf0.01")
    assert difference(df, con, ORACLES[name]) is None


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
