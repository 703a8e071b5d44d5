from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tripmart.operators import (
    Count,
    Dimension,
    Mean,
    Total,
    aggregate_trips,
    count_trips,
    enrich,
    join_zone,
    with_calendar,
)
from tripmart.schemas import ZONE_SCHEMA

ZONES = [
    (1, "North", "One", "Boro"),
    (2, "North", "Two", "Boro"),
    (3, "South", "Three", "Yellow"),
    (3, "South", "Three again", "Yellow"),  # an id that occurs twice
]

TRIPS = "business string, pickup_location int, dropoff_location int, month int, pay double"

trip = st.tuples(
    st.sampled_from(["A", "B", None]),
    st.sampled_from([1, 2, 3, 9, None]),
    st.sampled_from([1, 2, 3, 9, None]),
    st.integers(1, 2),
    st.one_of(st.none(), st.integers(-8, 8).map(float)),
)


def zones(spark, small=True):
    return Dimension(spark.createDataFrame(ZONES, ZONE_SCHEMA), small)


def report(trips, dimension):
    return aggregate_trips(
        trips,
        dimension,
        dimension,
        by={"area": F.col("Pickup_Borough"), "month": F.col("month")},
        trip_columns=["month"],
        metrics=[
            Count("trips"),
            Count("of_a", F.col("business") == "A"),
            Total("pay_sum", "pay"),
            Mean("pay_mean", "pay"),
        ],
    )


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(trip, max_size=40))
def test_hinted_and_plain_joins_agree_with_plain_python(spark, data):
    trips = spark.createDataFrame(data, TRIPS)
    expected: dict = {}
    for business, start, end, month, pay in data:
        for p in (z for z in ZONES if z[0] == start):
            for _ in (z for z in ZONES if z[0] == end):
                expected.setdefault((p[1], month), []).append((business, pay))
    wanted = []
    for key, group in expected.items():
        pays = [p for _, p in group if p is not None]
        total = sum(pays) if pays else None
        mean = total / len(pays) if pays else None
        wanted.append((*key, len(group), sum(b == "A" for b, _ in group), total, mean))
    wanted.sort(key=repr)
    assert rows(report(trips, zones(spark))) == wanted
    assert rows(report(trips, zones(spark, small=False))) == wanted


def test_distinct_keys_without_metrics(spark):
    trips = spark.createDataFrame([("A", 1, 2, 1, 1.0), ("B", 2, 1, 1, 1.0)], TRIPS)
    for small in (True, False):
        dimension = zones(spark, small)
        areas = aggregate_trips(
            trips,
            dimension,
            dimension,
            by={"area": F.col("Pickup_Borough")},
            trip_columns=[],
            metrics=[],
        )
        assert rows(areas) == [("North",)]


def test_inner_join_drops_unknown_zones_and_left_join_keeps_them(spark):
    trips = spark.createDataFrame([("A", 1, 9, 1, 1.0)], TRIPS)
    assert enrich(trips, zones(spark), zones(spark)).count() == 0
    kept = join_zone(trips, zones(spark), "dropoff_location", "Dropoff", how="left")
    assert kept.select("Dropoff_Borough").first()[0] is None


def test_enriched_columns(spark):
    trips = spark.createDataFrame([("A", 1, 3, 1, 1.0)], TRIPS)
    enriched = enrich(trips, zones(spark), zones(spark))
    assert enriched.columns == [
        *trips.columns,
        "Pickup_Borough",
        "Pickup_Zone",
        "Pickup_service_zone",
        "Dropoff_Borough",
        "Dropoff_Zone",
        "Dropoff_service_zone",
    ]


def test_measure_compares_rows_and_bytes(spark):
    frame = spark.createDataFrame(ZONES, ZONE_SCHEMA)
    assert Dimension.measure(frame).small
    assert not Dimension.measure(frame, max_rows=3).small
    assert not Dimension.measure(frame, max_bytes=10).small
    assert Dimension.measure(frame.limit(0)).small


@pytest.mark.parametrize(("seconds", "day"), [(0, "1970-01-01"), (1675209599, "2023-01-31")])
def test_calendar(spark, seconds, day):
    dated = with_calendar(spark.createDataFrame([(seconds,)], "date bigint"), year=True).first()
    assert str(dated.date) == day
    assert (dated.year, dated.month) == (dated.date.year, dated.date.month)


def test_money_is_summed_exactly(spark):
    rows_of = [("A", 1, 1, 1, v) for v in (0.1, 1e12, 0.2, -1e12, None, float("nan"))]
    money = Total("sum", "pay", digits=4)
    trips = spark.createDataFrame(rows_of, TRIPS)
    got = aggregate_trips(trips, zones(spark), zones(spark), by={"m": F.col("month")}, trip_columns=["month"], metrics=[money])
    assert rows(got) == [(1, 0.3)]


def test_trips_are_counted_by_pair(spark):
    trips = spark.createDataFrame([("A", 1, 3, 1, 1.0), ("A", 3, 3, 1, 1.0), ("A", 1, 9, 1, 1.0)], TRIPS)
    for small in (True, False):
        z = zones(spark, small)
        assert count_trips(trips, z, z, "n").first()[0] == enrich(trips, z, z).count() == 6
        assert count_trips(trips, z, z, "n", F.col("Pickup_Borough") == "Nowhere").first()[0] == 0


MONEY = st.one_of(
    st.none(),
    st.floats(allow_nan=True, allow_infinity=True),
    st.floats(-1e12, 1e12),
    st.integers(-(10**9), 10**9).map(lambda n: n / 100000),  # ties in the fifth place among them
    st.sampled_from([1e23, -1e23, 9.99999999999e9, 1.00005, -1.00005, 0.00005, 1e300, 10**10 - 0.00005]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(MONEY, max_size=30))
def test_money_is_the_sum_of_rounded_decimals(spark, values):
    total = Total("s", "v", digits=4)
    frame = spark.createDataFrame([(i % 3, v) for i, v in enumerate(values)], "k int, v double")
    parts = frame.groupBy("k").agg(*(c.alias(n) for n, c in total.partial().items()))
    got = parts.agg(total.merged().alias("s")).first()["s"]
    wide = F.sum(F.col("v").try_cast("decimal(28,4)")).cast("double")
    assert got == frame.agg(wide.alias("s")).first()["s"]
    if all(v is None or abs(v) < 1e9 for v in values):
        places = [Decimal(repr(v)).quantize(Decimal("0.0001"), ROUND_HALF_UP) for v in values if v is not None]
        assert got == (float(sum(places)) if places else None)
