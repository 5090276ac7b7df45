import pytest
from sidebyside import DATA, connect, difference

from __spark_entry__ import entry, oracle_sql, queries

SF = "sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = queries()[name](spark, f"{DATA}/{SF}")
    assert difference(df, duck, oracle_sql()[name]) is None


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_flagship(spark):
    assert entry(spark).count() > 0
