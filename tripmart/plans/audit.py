"""What the zone joins leave out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmart import operators
from tripmart.plans.mart import Mart


def lost_trips(mart: Mart) -> DataFrame:
    """Per provider and month (and year, where the mart has it)."""
    by = [c for c in ("business", "year", "month") if c in mart.trips.columns]
    return operators.lost_trips(mart.trips, mart.pickup, mart.dropoff, by)


def unknown_locations(mart: Mart) -> DataFrame:
    return operators.unknown_locations(mart.trips, mart.pickup, mart.dropoff)
