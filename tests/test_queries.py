from __future__ import annotations

import pytest

import __spark_entry__ as entry
from checks.compare import connect, difference
from tests.conftest import DATA


@pytest.fixture(scope="module")
def db():
    return connect(DATA)


def test_every_query_has_its_sql():
    assert entry.trip_queries().keys() == entry.trip_sql().keys()


# at this scale no supplier to customer route need be shared, no group need be large
EMPTY_IS_FINE = {"shared_routes_top10"}


@pytest.mark.parametrize("name", sorted(entry.trip_queries()))
def test_query_equals_its_sql(spark, db, name):
    query, sql = entry.trip_queries()[name], entry.trip_sql()[name]
    problem = difference(spark, db, query, sql, DATA)
    assert problem is None or (problem == "no rows" and name in EMPTY_IS_FINE)


def test_column_types_equal_those_of_the_sql(spark, db):
    kinds = {
        "string": "VARCHAR",
        "int": "INTEGER",
        "bigint": "BIGINT",
        "double": "DOUBLE",
        "date": "DATE",
    }
    for name, query in entry.trip_queries().items():
        mine = {c: kinds[t] for c, t in query(spark, DATA).dtypes}
        theirs = {d[0]: str(d[1]) for d in db.execute(entry.trip_sql()[name]).description}
        assert mine == theirs, name


def test_entry(spark):
    flagship = entry.entry(spark)
    assert flagship.columns == [
        "business",
        "month",
        "trip_count",
        "platform_profit",
        "driver_earnings",
    ]
    assert flagship.count() == 36


def test_invariants(spark):
    q = {name: query(spark, DATA) for name, query in entry.trip_queries().items()}
    keys = q["monthly_trip_count"].select("business", "month")
    assert keys.distinct().count() == keys.count()
    total = q["trip_row_count"].first().row_count
    assert q["monthly_trip_count"].groupBy().sum("trip_count").first()[0] == total
    assert q["graph_edges"].count() == total
    days = {tuple(r) for r in q["january_daily_wait"].collect()}
    assert len(days) == 31
    assert {tuple(r) for r in q["wait_anomalies"].collect()} <= days
    assert q["od_trips"].count() == q["od_trip_count"].first().trip_count
    assert q["same_area_edges"].count() == q["same_area_edge_count"].first().edge_count
