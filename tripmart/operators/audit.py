"""Trips that the zone joins drop, because a location is missing or not in the dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.operators.dimension import Dimension
from tripmart.operators.metrics import LOCATIONS

KNOWN, UNKNOWN, MISSING = "known", "unknown", "missing"


def location_state(rows: DataFrame, zones: Dimension, key: str, name: str) -> DataFrame:
    """Add ``name``: whether the id in ``key`` is known, unknown or missing (null).

    A row stays one row, however often its id occurs in the dimension.
    """
    ids = zones.rows.where(F.col("LocationID").isNotNull()).select(F.col("LocationID").alias(f"{name}_id"))
    joined = rows.join(zones.side(ids.distinct()), F.col(key) == F.col(f"{name}_id"), "left")
    state = (
        F.when(F.col(key).isNull(), MISSING)
        .when(F.col(f"{name}_id").isNull(), UNKNOWN)
        .otherwise(KNOWN)
    )
    return joined.withColumn(name, state).drop(f"{name}_id")


def lost_trips(trips: DataFrame, pickup: Dimension, dropoff: Dimension, by: list[str]) -> DataFrame:
    """Trips without both zones, counted by ``by`` and by the state of either end.

    Trips are counted by location pair before they meet the dimensions, so a
    location that holds a third of them is a few rows by then, a null one too.
    """
    folded = trips.groupBy(*LOCATIONS, *by).agg(F.count("*").alias("trip_count"))
    started = location_state(folded, pickup, LOCATIONS[0], "pickup")
    both = location_state(started, dropoff, LOCATIONS[1], "dropoff")
    lost = both.where((F.col("pickup") != KNOWN) | (F.col("dropoff") != KNOWN))
    return lost.groupBy(*by, "pickup", "dropoff").agg(F.sum("trip_count").alias("trip_count"))


def unknown_locations(trips: DataFrame, pickup: Dimension, dropoff: Dimension) -> DataFrame:
    """``role, location, trip_count`` of every location that its dimension lacks, null included.

    Both ends are counted in one pass. What is shuffled to large dimensions has one
    row per role and location; small ones are broadcast, and then Catalyst may drop
    known locations before the count. A trip counts once at each end that is not known.
    """

    def tagged(role: str, location: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), location.alias("location"))

    ends = F.array(*(tagged(role, F.col(key)) for role, key in zip(("pickup", "dropoff"), LOCATIONS, strict=True)))
    folded = trips.select(F.inline(ends)).groupBy("role", "location").agg(F.count("*").alias("trip_count"))
    ids = [
        zones.rows.select(F.lit(role).alias("role"), F.col("LocationID").alias("location"))
        for role, zones in (("pickup", pickup), ("dropoff", dropoff))
    ]
    known = Dimension(ids[0].unionByName(ids[1]), pickup.small and dropoff.small)
    return folded.join(known.side(known.rows), ["role", "location"], "left_anti")
