"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from compare import TESTDATA, connect, difference
from tidemark.oracles import ORACLES
from tidemark.queries import QUERIES

SF_DIR = TESTDATA / "sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns[0] == "datetime_utc" and rows.count() > 600


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    assert difference(spark, db, name, SF_DIR) is None
