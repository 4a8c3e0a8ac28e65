import pytest
from compare import differences, duck, duck_side, spark_side

from tidemark.llm import queries

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_its_sql(spark, name):
    assert differences(spark_side(queries.QUERIES[name](spark, DATA)), duck_side(duck(DATA), queries.ORACLES[name])) == []
