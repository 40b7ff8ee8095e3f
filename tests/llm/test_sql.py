import pytest

from tests.oracle import spark_rows, sql_rows, tables
from tidemark.llm import queries as module

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return tables(SF)


@pytest.mark.parametrize("name", module.oracle_sql())
def test_matches_sql(spark, duck, name):
    got_names, got = spark_rows(module.queries()[name](spark, SF))
    names, expected = sql_rows(duck, module.oracle_sql()[name])
    assert got_names == names
    assert sum(expected.values()) > 0
    assert got == expected
