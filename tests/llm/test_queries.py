from __future__ import annotations

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from tests.conftest import DATA
from tripmart.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def db():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, db, name):
    assert difference(spark, db, QUERIES[name], SQL[name], DATA) is None


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert QUERIES.keys() | {"pipeline"} <= entry.queries().keys()
    assert SQL.keys() <= entry.oracle_sql().keys()
