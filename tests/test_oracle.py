import pytest

from tests import oracle
from tidemark import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    oracle.check(spark, QUERIES[name], SQL[name])
