import os

import pytest

import __spark_entry__ as contract
from tests.compare import duck, oracle_rows, spark_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_equals_oracle(spark, oracle, name):
    names, rows = spark_rows(contract.queries()[name](spark, SF_DIR))
    expected_names, expected = oracle_rows(oracle, contract.oracle_sql()[name])
    assert names == expected_names
    assert len(rows) == len(expected) > 0
    assert rows == expected


def test_entry(spark):
    assert not contract.entry(spark).isEmpty()
