"""Routes that several providers serve."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmart.operators import shared_routes, top_k
from tripmart.plans.mart import Mart


def shared_routes_top(mart: Mart, businesses: dict[str, str], k: int = 10) -> DataFrame:
    shared = shared_routes(mart.trips, mart.pickup, mart.dropoff, businesses)
    return top_k(shared, "total_count", ["Route"], k)
