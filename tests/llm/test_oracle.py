"""The text operators' queries that SQL expresses, all rows, on the smallest tables."""

import pytest

import corpus_pipeline
import __spark_entry__ as entry_points
from tallymart.llm import queries
from tools.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    result = compare(spark, connect(FOLDER), queries.QUERIES[name], queries.ORACLES[name], FOLDER)
    assert not isinstance(result, str), result


def test_entry_points_offer_all():
    offered = entry_points.queries()
    assert offered["pipeline"] is corpus_pipeline.run
    assert set(queries.QUERIES) < set(offered) and set(queries.ORACLES) < set(entry_points.oracle_sql())
