"""All named reports over a mart, under the settings of a caller."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tripmart.operators import count_trips, schema_report
from tripmart.plans import audit, monthly, rankings, routes, selections, time_of_day, waiting, zone_graph
from tripmart.plans.mart import Mart

Report = Callable[[Mart], DataFrame]

#: Reports with a row for every trip or pair of zones, which grow with the trips.
ROW_TABLES = ("enriched_trips", "od_trips", "graph_edges", "graph_triplets", "same_area_edges")


@dataclass(frozen=True)
class Settings:
    """``shared`` names a count column for each business whose routes are compared."""

    provider: str
    shared: dict[str, str]
    time_of_day: str
    origin: str
    destination: str
    pickup_area: str = "Pickup_Borough"
    dropoff_area: str = "Dropoff_Borough"
    areas_per_month: int = 5
    paid_routes: int = 30
    shared_routes: int = 10
    ranked_zones: int = 5
    sparse_below: int = 1000
    long_wait: float = 300
    reset: float = 0.17
    tolerance: float = 0.01


def catalog(s: Settings) -> dict[str, Report]:
    return {
        "enriched_trips": enriched_trips,
        "trip_row_count": lambda m: count_trips(m.trips, m.pickup, m.dropoff, "row_count"),
        "trip_schema": lambda m: schema_report(enriched_trips(m)),
        "lost_trips": audit.lost_trips,
        "unknown_locations": audit.unknown_locations,
        "monthly_trip_count": monthly.monthly_trip_count,
        "monthly_platform_profit": monthly.monthly_platform_profit,
        "monthly_driver_earnings": monthly.monthly_driver_earnings,
        "monthly_report": monthly.monthly_all,
        "provider_series": lambda m: monthly.provider_series(monthly.monthly_all(m), s.provider),
        "pickup_boroughs": lambda m: rankings.areas(m, "Pickup_Borough"),
        "top_pickup_per_month": lambda m: rankings.top_areas_per_month(
            m, s.pickup_area, s.areas_per_month
        ),
        "top_dropoff_per_month": lambda m: rankings.top_areas_per_month(
            m, s.dropoff_area, s.areas_per_month
        ),
        "top_routes_by_pay": lambda m: rankings.top_routes_by_pay(
            m, s.pickup_area, s.dropoff_area, s.paid_routes
        ),
        "avg_pay_by_time_of_day": time_of_day.avg_pay_by_time_of_day,
        "avg_length_by_time_of_day": time_of_day.avg_length_by_time_of_day,
        "earning_per_mile": time_of_day.earning_per_mile,
        "january_daily_wait": waiting.january_daily_wait,
        "wait_anomalies": lambda m: waiting.wait_anomalies(m, s.long_wait),
        "sparse_groups": lambda m: selections.sparse_groups(m, s.sparse_below),
        "evening_groups": lambda m: selections.groups_at(m, s.time_of_day),
        "od_trips": lambda m: selections.od_trips(m, s.origin, s.destination),
        "od_trip_count": lambda m: selections.od_trip_count(m, s.origin, s.destination),
        "od_trip_preview": lambda m: selections.od_trip_preview(m, s.origin, s.destination),
        "shared_routes_top10": lambda m: routes.shared_routes_top(m, s.shared, s.shared_routes),
        "graph_vertices": zone_graph.graph_vertices,
        "graph_edges": zone_graph.graph_edges,
        "graph_triplets": zone_graph.flat_triplets,
        "same_area_edges": zone_graph.same_area_edges,
        "same_area_edge_count": zone_graph.same_area_edge_count,
        "pagerank_top5": lambda m: zone_graph.pagerank_top(
            m, s.ranked_zones, s.reset, s.tolerance
        ),
    }


def enriched_trips(mart: Mart) -> DataFrame:
    """Trips with both zones and a DATE."""
    return mart.enriched.drop("month", "year")
