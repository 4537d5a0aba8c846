"""Each registered query against its SQL oracle."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from granary.queries import REGISTRY
from tests.oracle import connect, oracle_rows, spark_rows

QUERIES = {name: run for name, run in queries().items() if name in REGISTRY}
ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, data, duck, name):
    names, rows = spark_rows(QUERIES[name](spark, data))
    expected_names, expected = oracle_rows(duck, ORACLES[name])
    assert names == expected_names
    assert sum(rows.values()) == sum(expected.values())
    assert rows == expected
    assert rows, "an empty result checks nothing"


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["c_custkey", "c_name", "n_name", "o_orderkey", "o_totalprice", "total", "average"]
    assert result.count() > 0
