import pytest

import __spark_entry__ as contract
from tests.oracle import spark_rows, sql_rows, tables

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return tables(SF)


def test_every_query_has_sql():
    assert contract.own_queries().keys() == contract.own_oracle_sql().keys()


@pytest.mark.parametrize("name", contract.own_queries())
def test_matches_sql(spark, duck, name):
    got_names, got = spark_rows(contract.queries()[name](spark, SF))
    names, expected = sql_rows(duck, contract.oracle_sql()[name])
    assert got_names == names
    assert sum(expected.values()) > 0
    assert got == expected


def test_entry(spark):
    assert contract.entry(spark).count() == 34
