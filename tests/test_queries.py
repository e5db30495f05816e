import oracle
import pytest

import __spark_entry__ as entry_module
from lienflow.plans.oracles import ORACLES
from lienflow.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF_DIR)


def test_flagship(spark):
    assert entry_module.entry(spark).count() == 25


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_module.queries().keys() and ORACLES.keys() <= entry_module.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    rows, columns, ours, theirs = oracle.differences(spark, connection, QUERIES[name], ORACLES[name], SF_DIR)
    assert (columns, ours, theirs) == ([], [], []) and rows > 0
