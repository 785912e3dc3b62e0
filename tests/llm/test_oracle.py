import pytest
from parity import TESTDATA, differences, duck

from tallyhouse.llm.queries import oracle_sql, queries

FOLDER = str(TESTDATA / "sf0.001")


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_equals_sql(spark, name):
    rows, problem = differences(queries()[name](spark, FOLDER), duck(FOLDER), oracle_sql()[name])
    assert rows and not problem
