import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries
from daybook.plans.oracles import ORACLES
from daybook.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    opened = connect(SF_DIR)
    yield opened
    opened.close()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, connection, name):
    assert difference(spark, connection, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_each_query_is_registered_and_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    frame = entry(spark)
    assert frame.count() > 0
    assert frame.schema == entry(spark).schema
