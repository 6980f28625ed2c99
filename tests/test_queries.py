import pytest
from compare import connect, duck_table, spark_table, type_differences
from conftest import SMALLEST

import __spark_entry__ as entry
from funnelspark.oracle import ORACLE
from funnelspark.queries import QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    with connect(SMALLEST) as connection:
        yield connection


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, SMALLEST)
    assert type_differences(result, duck, ORACLE[name]) == []
    found, expected = spark_table(result), duck_table(duck, ORACLE[name])
    assert found[0] == expected[0]
    assert found[1] == expected[1]
    assert found[1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
