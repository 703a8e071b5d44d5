from __future__ import annotations

import re

from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tripmart.operators import (
    Dimension,
    between_exclusive,
    equals,
    exceeds,
    preview,
    row_count,
    schema_report,
    shared_routes,
    top_k,
    top_n_per_group,
)
from tripmart.schemas import ZONE_SCHEMA

COUNTS = [
    (m, area, n) for m in (1, 2) for area, n in [("a", 5), ("b", 7), ("c", 5), ("d", 1), ("e", 7)]
]


def counts(spark):
    return spark.createDataFrame(COUNTS, "month int, area string, trip_count bigint")


def test_top_n_breaks_ties_by_key(spark):
    top = top_n_per_group(counts(spark), ["month"], "trip_count", ["area"], 3)
    assert rows(top) == [(m, a, n) for m in (1, 2) for a, n in [("a", 5), ("b", 7), ("e", 7)]]
    assert "WindowGroupLimit" in plan(top)


def test_top_k_breaks_ties_by_key(spark):
    top = top_k(counts(spark).filter("month = 1"), "trip_count", ["area"], 3)
    assert [r.area for r in top.collect()] == ["b", "e", "a"]
    assert "TakeOrderedAndProject" in plan(top)


def test_filters(spark):
    one = counts(spark).filter("month = 1")
    assert [r.area for r in between_exclusive(one, "trip_count", 1, 7).collect()] == ["a", "c"]
    assert [r.area for r in exceeds(one, "trip_count", 5).collect()] == ["b", "e"]
    assert [r.trip_count for r in equals(one, area="d", month=1).collect()] == [1]


def test_profile(spark):
    frame = counts(spark)
    assert rows(row_count(frame)) == [(10,)]
    assert rows(schema_report(frame)) == [
        (0, "month", "int", 10, 10),
        (1, "area", "string", 10, 10),
        (2, "trip_count", "bigint", 10, 10),
    ]
    assert preview(frame, 4).count() == 4
    first = preview(frame, 2, F.col("area"), F.col("month")).collect()
    assert [tuple(r)[:2] for r in first] == [(1, "a"), (2, "a")]


def test_shared_routes_equal_the_join_of_two_counts(spark):
    # several ids of one name, an id that occurs twice, and trips to an unknown one
    zones = [(i, "", f"zone {i % 3}", "") for i in (0, 1, 2, 3, 4, 4)]
    trips = spark.createDataFrame(
        [("XYZ"[(i * i + j) % 3], i % 5, (i * j) % 6) for i in range(30) for j in range(9)],
        "business string, pickup_location int, dropoff_location int",
    )
    frame = spark.createDataFrame(zones, ZONE_SCHEMA)
    p = frame.select(F.col("LocationID").alias("pickup_location"), F.col("Zone").alias("p"))
    d = frame.select(F.col("LocationID").alias("dropoff_location"), F.col("Zone").alias("d"))
    named = (
        trips.join(p, "pickup_location")
        .join(d, "dropoff_location")
        .select("business", F.concat_ws(" to ", "p", "d").alias("Route"))
    )
    x = named.filter("business = 'X'").groupBy("Route").agg(F.count("*").alias("x"))
    y = named.filter("business = 'Y'").groupBy("Route").agg(F.count("*").alias("y"))
    wanted = rows(x.join(y, "Route").withColumn("total", F.col("x") + F.col("y")))
    for small in (True, False):
        side = Dimension(frame, small)
        assert rows(shared_routes(trips, side, side, {"x": "X", "y": "Y"})) == wanted


def test_shared_routes_shuffle_no_names(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    trips = spark.createDataFrame([("X", 1, 2)], "business string, pickup_location int, dropoff_location int")
    side = Dimension(spark.createDataFrame([(1, "", "a", ""), (2, "", "b", "")], ZONE_SCHEMA), False)
    text = plan(shared_routes(trips, side, side, {"x": "X", "y": "Y"}))
    moved = re.findall(r"Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)
    # what carries counts carries no name until the last joins, which have the served routes only
    assert [m for m in moved if "x#" in m and "_name" not in m and "Zone" not in m]
    assert sum("x#" in m and "Zone" in m for m in moved) == 0
