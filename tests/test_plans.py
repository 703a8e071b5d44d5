"""What the plans must look like to hold on a cluster."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import DATA, final_plan, plan, rows
from tripmart.operators import Dimension, join_zone
from tripmart.schemas import ZONE_SCHEMA

LARGE = {"spark.sql.autoBroadcastJoinThreshold": -1}


@pytest.mark.parametrize("name", sorted(entry.trip_queries()))
def test_no_python_workers_and_no_pairs_without_keys(spark, name):
    text = plan(entry.trip_queries()[name](spark, DATA))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_scan_reads_only_what_a_count_needs(spark):
    text = plan(entry.trip_queries()["monthly_trip_count"](spark, DATA))
    (read,) = {m for m in re.findall(r"ReadSchema: struct<(l_[^>]*)>", text)}
    assert [c.split(":")[0] for c in read.split(",")] == [
        "l_orderkey",
        "l_suppkey",
        "l_returnflag",
        "l_shipdate",
    ]


@pytest.mark.parametrize(
    ("name", "filters"),
    [
        ("evening_groups", ["EqualTo(o_orderpriority,2-HIGH)"]),
        ("provider_series", ["EqualTo(l_returnflag,A)"]),
        ("od_trips", ["EqualTo(r_name,AFRICA)", "EqualTo(r_name,ASIA)"]),
        ("shared_routes_top10", ["In(l_returnflag, [A,N])"]),
    ],
)
def test_filters_reach_the_scan(spark, name, filters):
    text = plan(entry.trip_queries()[name](spark, DATA))
    assert all(f in text for f in filters)


def test_od_trips_narrow_suppliers_and_customers_before_the_fact_joins(spark):
    text = plan(entry.trip_queries()["od_trips"](spark, DATA))
    semi = re.findall(r"Left keys \[1\]: \[(\w+)#\d+\]\n.*\nJoin type: LeftSemi", text)
    assert sorted(semi) == ["c_nationkey", "s_nationkey"]


def test_line_items_are_shuffled_for_two_joins_only(spark, conf):
    for key, value in LARGE.items():
        conf(key, value)
    text = plan(entry.trip_queries()["monthly_report"](spark, DATA))
    wide = [
        block
        for block in re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)
        if "l_extendedprice" in block
    ]
    assert len(wide) == 2


def test_one_pass_for_several_metrics(spark):
    for name in ("earning_per_mile", "monthly_report", "shared_routes_top10"):
        text = plan(entry.trip_queries()[name](spark, DATA))
        assert text.count("Location: InMemoryFileIndex [file:" + DATA + "/lineitem") == 1


def test_a_hot_zone_is_split_when_the_dimension_is_large(spark, conf):
    for key, value in LARGE.items():
        conf(key, value)
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    conf("spark.sql.shuffle.partitions", 32)
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20KB")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20KB")
    trips = spark.range(0, 60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).cast("int").alias("start"),
        F.col("id").alias("trip"),
    )
    zones = spark.range(500).select(
        F.col("id").cast("int").alias("LocationID"),
        F.lit("b").alias("Borough"),
        F.concat(F.lit("z"), F.col("id")).alias("Zone"),
        F.lit("s").alias("service_zone"),
    )
    joined = join_zone(trips, Dimension(zones, small=False), "start", "Pickup")
    assert "skew=true" in final_plan(joined)
    assert joined.count() == 60_000


def test_only_measured_dimensions_are_hinted(spark):
    zones = spark.createDataFrame([(1, "b", "z", "s")], ZONE_SCHEMA)
    trips = spark.range(10).select(F.lit(1).alias("start"), "id")
    hinted = join_zone(trips, Dimension(zones, small=True), "start", "Pickup")
    plain = join_zone(trips, Dimension(zones, small=False), "start", "Pickup")

    def logical(frame):
        return frame._jdf.queryExecution().logical().toString()

    assert "broadcast" in logical(hinted)
    assert "broadcast" not in logical(plain)
    assert rows(hinted) == rows(plain)
