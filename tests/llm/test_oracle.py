import pytest

from tests import oracle
from tidemark.llm import queries

QUERIES, SQL = queries.queries(), queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    oracle.check(spark, QUERIES[name], SQL[name])


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
