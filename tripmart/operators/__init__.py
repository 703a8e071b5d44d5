"""Operators from DataFrame to DataFrame; names and thresholds are parameters."""

from tripmart.operators.audit import location_state, lost_trips, unknown_locations
from tripmart.operators.dimension import Dimension
from tripmart.operators.enrich import enrich, join_zone, with_calendar
from tripmart.operators.filters import between_exclusive, equals, exceeds, in_months
from tripmart.operators.graph import (
    Graph,
    edge_weights,
    motif_count,
    motif_edge,
    triplets,
    trip_edges,
    zone_vertices,
)
from tripmart.operators.metrics import Count, Mean, Metric, Total, aggregate_trips, count_trips
from tripmart.operators.vertex_rank import pagerank
from tripmart.operators.profile import preview, row_count, schema_report
from tripmart.operators.ranking import top_k, top_n_per_group
from tripmart.operators.routes import shared_routes

__all__ = [
    "Count",
    "Dimension",
    "Graph",
    "Mean",
    "Metric",
    "Total",
    "aggregate_trips",
    "between_exclusive",
    "count_trips",
    "edge_weights",
    "enrich",
    "equals",
    "exceeds",
    "in_months",
    "join_zone",
    "location_state",
    "lost_trips",
    "motif_count",
    "motif_edge",
    "pagerank",
    "preview",
    "row_count",
    "schema_report",
    "shared_routes",
    "top_k",
    "top_n_per_group",
    "trip_edges",
    "triplets",
    "unknown_locations",
    "with_calendar",
    "zone_vertices",
]
