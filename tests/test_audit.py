from __future__ import annotations

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import plan, rows
from tripmart.operators import Dimension, count_trips, lost_trips, unknown_locations
from tripmart.schemas import ZONE_SCHEMA

TRIPS = "business string, pickup_location int, dropoff_location int"
ZONES = [(1, "N", "One", ""), (2, "N", "Two", ""), (2, "N", "Two again", ""), (None, "N", "No id", "")]
ENDS = [(3, "S", "Three", ""), (1, "S", "One", "")]

location = st.sampled_from([1, 2, 3, 9, None])
trip = st.tuples(st.sampled_from(["A", "B", None]), location, location)


def dimension(spark, data, small):
    return Dimension(spark.createDataFrame(data, ZONE_SCHEMA), small)


def state(value, data):
    if value is None:
        return "missing"
    return "known" if value in {z[0] for z in data} else "unknown"


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(trip, max_size=40), st.booleans())
def test_equals_plain_python(spark, data, small):
    trips = spark.createDataFrame(data, TRIPS)
    starts, ends = dimension(spark, ZONES, small), dimension(spark, ENDS, small)
    states = [(b, state(p, ZONES), state(d, ENDS)) for b, p, d in data]
    lost = Counter(s for s in states if s[1:] != ("known", "known"))
    assert rows(lost_trips(trips, starts, ends, ["business"])) == sorted(((*k, n) for k, n in lost.items()), key=repr)
    places = Counter(("pickup", p) for _, p, _ in data if state(p, ZONES) != "known")
    places += Counter(("dropoff", d) for _, _, d in data if state(d, ENDS) != "known")
    assert rows(unknown_locations(trips, starts, ends)) == sorted(((*k, n) for k, n in places.items()), key=repr)


def test_lost_and_kept_trips_are_all_trips(spark):
    trips = spark.createDataFrame([("A", p, d) for p in (1, 3, 9, None) for d in (1, 3, 9, None)] * 3, TRIPS)
    zones = dimension(spark, ENDS, True)
    lost = lost_trips(trips, zones, zones, []).groupBy().sum("trip_count").first()[0]
    assert lost + count_trips(trips, zones, zones, "n").first().n == trips.count()


@pytest.mark.parametrize("small", [True, False])
def test_trips_are_counted_before_they_meet_the_zones(spark, conf, small):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    hot = spark.range(30_000).selectExpr(
        "'A' AS business", "IF(id % 3 = 0, NULL, IF(id % 3 = 1, 9, 1)) AS pickup_location", "1 AS dropoff_location"
    )
    zones = dimension(spark, ZONES, small)
    join = "BroadcastHashJoin" if small else "SortMergeJoin"
    for report in (lost_trips(hot, zones, zones, ["business"]), unknown_locations(hot, zones, zones)):
        text = plan(report)
        tree = text[: text.index("(1) ")]
        assert join in tree
        # a tree is printed from the last operator on: the aggregate below the last join is the fold;
        # Catalyst moves an anti join with a broadcast side below it, where it shuffles nothing
        if not small or "LeftAnti" not in tree:
            assert "HashAggregate" in tree[tree.rindex(join) :]
    assert rows(unknown_locations(hot, zones, zones)) == [("pickup", 9, 10_000), ("pickup", None, 10_000)]
