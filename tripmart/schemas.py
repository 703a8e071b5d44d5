"""Column names and types of the inputs and of the saved reports.

Names, their order and the spaced report headings are fixed values: files are
read by position and reports are read back by heading.
"""

from __future__ import annotations

from pyspark.sql import types as T

TRIP_SCHEMA = T.StructType(
    [
        T.StructField("business", T.StringType()),
        T.StructField("pickup_location", T.IntegerType()),
        T.StructField("dropoff_location", T.IntegerType()),
        T.StructField("trip_length", T.DoubleType()),
        T.StructField("request_to_pickup", T.DoubleType()),
        T.StructField("total_ride_time", T.DoubleType()),
        T.StructField("on_scene_to_pickup", T.DoubleType()),
        T.StructField("on_scene_to_dropoff", T.DoubleType()),
        T.StructField("time_of_day", T.StringType()),
        T.StructField("date", T.LongType()),  # unix seconds
        T.StructField("passenger_fare", T.DoubleType()),
        T.StructField("driver_total_pay", T.DoubleType()),
        T.StructField("rideshare_profit", T.DoubleType()),
        T.StructField("hourly_rate", T.DoubleType()),
        T.StructField("dollars_per_mile", T.DoubleType()),
    ]
)

ZONE_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)

ZONE_LABELS = ("Borough", "Zone", "service_zone")

# Result column -> heading in the saved report.
REPORT_HEADINGS = {
    "platform_profit": "Platform Profit",
    "driver_earnings": "Driver Earnings",
}

MONTHLY_COUNT_REPORT = T.StructType(
    [
        T.StructField("business", T.StringType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("trip_count", T.LongType()),
    ]
)

MONTHLY_PROFIT_REPORT = T.StructType(
    [
        T.StructField("business", T.StringType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("Platform Profit", T.DoubleType()),
    ]
)

MONTHLY_EARNINGS_REPORT = T.StructType(
    [
        T.StructField("business", T.StringType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("Driver Earnings", T.DoubleType()),
    ]
)

DAILY_WAIT_REPORT = T.StructType(
    [
        T.StructField("day", T.IntegerType()),
        T.StructField("average_waiting_time", T.DoubleType()),
    ]
)
