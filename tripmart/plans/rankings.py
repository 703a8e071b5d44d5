"""Busiest areas per month and best paid routes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmart.functions import rank_order, route_label
from tripmart.operators import Count, Total, top_k, top_n_per_group
from tripmart.plans.mart import Mart


def areas(mart: Mart, area: str) -> DataFrame:
    """Distinct values of a zone column over the trips."""
    return mart.report({area: area}, [])


def top_areas_per_month(mart: Mart, area: str, n: int = 5) -> DataFrame:
    trips = mart.report({area: area, "month": "month"}, ["month"], Count("trip_count"))
    busiest = top_n_per_group(trips, ["month"], "trip_count", [area], n)
    return busiest.orderBy("month", *rank_order("trip_count", area))


def top_routes_by_pay(mart: Mart, origin: str, destination: str, k: int = 30) -> DataFrame:
    pay = mart.report(
        {"Route": route_label(origin, destination)}, [], Total("total_profit", "driver_total_pay", digits=4)
    )
    return top_k(pay, "total_profit", ["Route"], k)
