"""Filters over groups and over trips."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators import Count, between_exclusive, count_trips, equals, preview
from tripmart.plans.mart import Mart


def borough_time_counts(mart: Mart) -> DataFrame:
    def counted() -> DataFrame:
        return mart.report(
            {"Pickup_Borough": "Pickup_Borough", "time_of_day": "time_of_day"},
            ["time_of_day"],
            Count("trip_count"),
        )

    shared = mart.family("by borough and time", counted)
    return counted() if shared is None else shared


def sparse_groups(mart: Mart, below: int = 1000, above: int = 0) -> DataFrame:
    return between_exclusive(borough_time_counts(mart), "trip_count", above, below)


def groups_at(mart: Mart, time_of_day: str) -> DataFrame:
    """Catalyst moves the filter on the group key below the aggregate, to the scan."""
    return equals(borough_time_counts(mart), time_of_day=time_of_day)


def _located(mart: Mart, origin: str, destination: str) -> DataFrame:
    """Trips whose ends can match, by zone id.

    A semi join on ids says before the zone joins which trips can match, and
    Catalyst moves it to the table that an id comes from.
    """
    trips = mart.trips
    ends = (
        ("pickup_location", mart.pickup, origin),
        ("dropoff_location", mart.dropoff, destination),
    )
    for key, zones, borough in ends:
        ids = equals(zones.rows, Borough=borough).select(F.col("LocationID").alias(f"{key}_id"))
        trips = trips.join(zones.side(ids), F.col(key) == F.col(f"{key}_id"), "left_semi")
    return trips


def od_trips(mart: Mart, origin: str, destination: str) -> DataFrame:
    located = replace(mart, trips=_located(mart, origin, destination))
    chosen = equals(located.enriched, Pickup_Borough=origin, Dropoff_Borough=destination)
    return chosen.select("Pickup_Borough", "Dropoff_Borough", "Pickup_Zone")


def od_trip_count(mart: Mart, origin: str, destination: str) -> DataFrame:
    """Counted by location pair, before the zone joins."""
    both = (F.col("Pickup_Borough") == origin) & (F.col("Dropoff_Borough") == destination)
    located = _located(mart, origin, destination)
    return count_trips(located, mart.pickup, mart.dropoff, "trip_count", both)


def od_trip_preview(mart: Mart, origin: str, destination: str, n: int = 10) -> DataFrame:
    """First rows of ``od_trips`` in the order of all columns."""
    trips = od_trips(mart, origin, destination)
    return preview(trips, n, *(F.col(c) for c in trips.columns))
