"""Trips, zones and raw lines as views over the order tables.

A line item is a trip: its return flag is the provider, the supplier is the
origin, the customer the destination, nations are zones and regions boroughs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.schemas import TRIP_SCHEMA, ZONE_SCHEMA


@dataclass(frozen=True)
class OrderTables:
    spark: SparkSession
    root: str

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root.rstrip('/')}/{name}.parquet")


def unix_seconds(ts: str) -> Column:
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def _trip_columns(pickup: str, dropoff: str) -> list[Column]:
    fare = F.col("l_extendedprice")
    pay = fare * (1 - F.col("l_discount"))
    seconds = F.col("l_quantity") * 60.0
    on_scene = F.col("l_linenumber").cast("double")
    values = {
        "business": F.col("l_returnflag"),
        "pickup_location": F.col(pickup),
        "dropoff_location": F.col(dropoff),
        "trip_length": F.col("l_quantity"),
        "request_to_pickup": F.abs(F.datediff("l_shipdate", "o_orderdate")).cast("double"),
        "total_ride_time": seconds,
        "on_scene_to_pickup": on_scene,
        "on_scene_to_dropoff": on_scene + seconds,
        "time_of_day": F.col("o_orderpriority"),
        "date": unix_seconds("l_shipdate"),
        "passenger_fare": fare,
        "driver_total_pay": pay,
        "rideshare_profit": fare * (F.col("l_tax") - F.col("l_discount")),
        "hourly_rate": F.try_divide(pay * 3600.0, seconds),
        "dollars_per_mile": F.try_divide(pay, F.col("l_quantity")),
    }
    return [values[name].alias(name) for name in TRIP_SCHEMA.fieldNames()]


def trips_by_nation(table: OrderTables) -> DataFrame:
    """Trips between nations.

    Line items meet suppliers, orders meet customers, and the two meet last: the
    line items are shuffled for two keys and not for three, and what orders add
    to them is not shuffled again. Spark chooses each join from the sizes it
    sees; a hot order, customer or supplier is split by the adaptive skew join.
    """
    origins = table("lineitem").join(
        table("supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    destinations = (
        table("orders")
        .join(table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_orderdate", "o_orderpriority", "c_nationkey")
    )
    return origins.join(destinations, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *_trip_columns("s_nationkey", "c_nationkey")
    )


def nation_zones(table: OrderTables) -> DataFrame:
    third = F.col("n_nationkey") % 3
    return (
        table("nation")
        .join(table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey").alias("LocationID"),
            F.col("r_name").alias("Borough"),
            F.col("n_name").alias("Zone"),
            F.when(third == 0, "Yellow")
            .when(third == 1, "Boro")
            .otherwise("Airports")
            .alias("service_zone"),
        )
    )


def trips_by_party(table: OrderTables) -> DataFrame:
    """Trips from one supplier to one customer: locations that grow with the data."""
    return (
        table("lineitem")
        .join(table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(*_trip_columns("l_suppkey", "o_custkey"))
    )


def supplier_zones(table: OrderTables) -> DataFrame:
    """Suppliers as zones, one borough per nation number."""
    return table("supplier").select(
        F.col("s_suppkey").alias("LocationID"),
        F.col("s_nationkey").cast("string").alias("Borough"),
        F.col("s_name").alias("Zone"),
        F.lit("").alias("service_zone"),
    )


def customer_zones(table: OrderTables) -> DataFrame:
    """Customers as zones, one borough per nation number."""
    return table("customer").select(
        F.col("c_custkey").alias("LocationID"),
        F.col("c_nationkey").cast("string").alias("Borough"),
        F.col("c_name").alias("Zone"),
        F.col("c_mktsegment").alias("service_zone"),
    )


TRIP_HEADER = ",".join(TRIP_SCHEMA.fieldNames())
ZONE_HEADER = ",".join(ZONE_SCHEMA.fieldNames())


def _with_headers(line: Column, header: str, after: Column) -> Column:
    return F.explode(F.when(after, F.array(F.lit(header), line)).otherwise(F.array(line)))


def trip_lines(table: OrderTables) -> DataFrame:
    """Line items as comma text, with the faults that raw files have.

    The line number picks the fault: 1 repeats the header, 4 holds a quoted
    comma, 5 has a blank and a word in place of numbers, 6 lacks a field and 7
    has one too many.
    """
    number = F.col("l_linenumber")
    numeric = [
        F.col("l_quantity"),
        number,
        F.col("l_quantity"),
        F.col("l_tax"),
        F.col("l_discount"),
    ]
    time_of_day = F.when(number == 4, F.lit('"late, night"')).otherwise(F.col("l_linestatus"))
    hourly_rate = F.when(number == 5, F.lit("")).otherwise(F.col("l_tax").cast("string"))
    per_mile = F.when(number == 5, F.lit("n/a")).otherwise(F.col("l_discount").cast("string"))
    fields = [
        F.col("l_returnflag"),
        F.col("l_suppkey").cast("string"),
        F.col("l_partkey").cast("string"),
        *(c.cast("string") for c in numeric),
        time_of_day,
        unix_seconds("l_shipdate").cast("string"),
        F.col("l_extendedprice").cast("string"),
        F.col("l_quantity").cast("string"),
        F.col("l_tax").cast("string"),
        hourly_rate,
    ]
    last = F.when(number == 6, "").otherwise(F.concat(F.lit(","), per_mile))
    surplus = F.when(number == 7, ",").otherwise("")
    line = F.concat(F.concat_ws(",", *fields), last, surplus)
    return table("lineitem").select(_with_headers(line, TRIP_HEADER, number == 1).alias("value"))


def zone_lines(table: OrderTables) -> DataFrame:
    """Customers as quoted zone text.

    Segment BUILDING repeats the header, MACHINERY holds a quoted comma and
    AUTOMOBILE has blank labels.
    """
    segment = F.col("c_mktsegment")

    def quoted(c: Column) -> Column:
        return F.concat(F.lit('"'), c, F.lit('"'))

    blank = segment == "AUTOMOBILE"
    name = F.when(segment == "MACHINERY", F.concat(F.col("c_name"), F.lit(", annex")))
    line = F.concat_ws(
        ",",
        F.col("c_custkey").cast("string"),
        F.when(blank, F.lit("")).otherwise(quoted(segment)),
        quoted(name.otherwise(F.col("c_name"))),
        F.when(blank, F.lit("")).otherwise(quoted(F.col("c_nationkey").cast("string"))),
    )
    return table("customer").select(
        _with_headers(line, ZONE_HEADER, segment == "BUILDING").alias("value")
    )
