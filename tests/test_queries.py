"""Every registered query against its SQL, on the smallest data set."""

import pytest

import __spark_entry__ as contract
from check import difference, duck

SF_DIR = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()

@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_oracle_belongs_to_a_query():
    assert SQL.keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    result = contract.queries()[name](spark, SF_DIR)
    if name in SQL:
        assert difference(result, con, SQL[name]) is None
    else:
        assert result.count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
