"""Every query against its SQL, all rows, on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from tallymart.queries import oracles, queries
from tools.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
SQL = oracles()
QUERIES = queries()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    result = compare(spark, con, QUERIES[name], SQL[name], FOLDER)
    assert not isinstance(result, str), result


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() == 7 and df.columns[0] == "survey_year"
