"""Routes between zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.functions import route_label
from tripmart.operators.dimension import Dimension
from tripmart.operators.metrics import LOCATIONS


def shared_routes(
    trips: DataFrame,
    pickup: Dimension,
    dropoff: Dimension,
    businesses: dict[str, str],
) -> DataFrame:
    """Zone routes that all businesses serve, with a count for each and the total.

    ``businesses`` maps the name of a count column to the business it counts. A
    route is a pair of zone names. Names may repeat, so within each dimension the
    least id with a name stands for it: trips are counted by location pair, then
    by the two ids, routes that a business lacks go, and only the rest get their
    names. No text is shuffled before that. An id that occurs twice in a
    dimension counts twice, trips with an unknown id do not count.
    """
    counts = [
        F.count_if(F.col("business") == business).alias(name)
        for name, business in businesses.items()
    ]
    routes = (
        trips.filter(F.col("business").isin(*businesses.values()))
        .groupBy(*LOCATIONS)
        .agg(*counts)
    )
    named = []
    for key, zones, end in zip(LOCATIONS, (pickup, dropoff), ("origin", "destination"), strict=True):
        names = zones.rows.groupBy("Zone").agg(F.min("LocationID").alias(end))
        ids = zones.rows.select(F.col("LocationID").alias(key), F.col("Zone").alias("own")).join(
            zones.side(names), F.col("own").eqNullSafe(F.col("Zone"))
        )
        routes = routes.join(zones.side(ids.select(key, end)), key)
        named.append((zones, names.withColumnRenamed("Zone", f"{end}_name"), end))
    served = routes.groupBy("origin", "destination").agg(*(F.sum(n).alias(n) for n in businesses))
    for name in businesses:
        served = served.filter(F.col(name) > 0)
    for zones, names, end in named:
        served = served.join(zones.side(names), end)
    total = [F.col(name) for name in businesses]
    return served.select(
        route_label("origin_name", "destination_name").alias("Route"),
        *businesses,
        sum(total[1:], total[0]).alias("total_count"),
    )
