"""Zone labels and calendar columns for trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions import epoch_date
from tripmart.operators.dimension import Dimension
from tripmart.schemas import ZONE_LABELS


def join_zone(
    trips: DataFrame, zones: Dimension, key: str, role: str, how: str = "inner"
) -> DataFrame:
    """Add ``<role>_Borough``, ``<role>_Zone`` and ``<role>_service_zone``.

    The dimension is renamed before the join, so it can be joined once per role.
    With ``how='inner'`` a trip whose zone is unknown is dropped.
    """
    zone_key = f"{role}_LocationID"
    labels = zones.rows.select(
        F.col("LocationID").alias(zone_key),
        *(F.col(label).alias(f"{role}_{label}") for label in ZONE_LABELS),
    )
    matched = F.col(key) == F.col(zone_key)
    return trips.join(zones.side(labels), matched, how).drop(zone_key)


def enrich(
    trips: DataFrame, pickup: Dimension, dropoff: Dimension, how: str = "inner"
) -> DataFrame:
    """Both zone joins."""
    started = join_zone(trips, pickup, "pickup_location", "Pickup", how)
    return join_zone(started, dropoff, "dropoff_location", "Dropoff", how)


def with_calendar(trips: DataFrame, year: bool = False) -> DataFrame:
    """Epoch ``date`` to DATE, plus ``month`` (and ``year`` for data of several years)."""
    dated = trips.withColumn("date", epoch_date("date"))
    parts = {"month": F.month("date")}
    if year:
        parts["year"] = F.year("date")
    return dated.withColumns(parts)
