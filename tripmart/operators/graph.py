"""Zones as vertices, trips as edges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.operators.dimension import Dimension

SAME_AREA = "a.Borough = b.Borough AND a.service_zone = b.service_zone"


@dataclass(frozen=True)
class Graph:
    """``vertices`` have a column ``id``; ``edges`` are ``src, dst``, one row per trip."""

    vertices: Dimension
    edges: DataFrame


def zone_vertices(zones: DataFrame) -> DataFrame:
    return zones.select(F.col("LocationID").alias("id"), "Borough", "Zone", "service_zone")


def trip_edges(trips: DataFrame) -> DataFrame:
    return trips.select(
        F.col("pickup_location").alias("src"), F.col("dropoff_location").alias("dst")
    )


def edge_weights(edges: DataFrame) -> DataFrame:
    """Parallel edges folded into one row with their number ``w``."""
    return edges.groupBy("src", "dst").agg(F.count("*").alias("w"))


def _both_ends(edges: DataFrame, vertices: Dimension, predicate: Column | None = None) -> DataFrame:
    """Edges ``e`` with their source ``a`` and destination ``b``."""
    starts = vertices.side(vertices.rows).alias("a")
    ends = vertices.side(vertices.rows).alias("b")
    arrives = F.col("e.dst") == F.col("b.id")
    if predicate is not None:
        arrives = arrives & predicate
    return edges.alias("e").join(starts, F.col("e.src") == F.col("a.id")).join(ends, arrives)


def triplets(graph: Graph) -> DataFrame:
    """Distinct ``src, edge, dst`` structs.

    Edges and vertices are made distinct before the joins, which gives the same
    rows as making the joined rows distinct.
    """
    vertices = Dimension(graph.vertices.rows.distinct(), graph.vertices.small)
    return _both_ends(graph.edges.distinct(), vertices).select(
        F.struct("a.*").alias("src"), F.struct("e.*").alias("edge"), F.struct("b.*").alias("dst")
    )


def motif_edge(graph: Graph, predicate: str = SAME_AREA) -> DataFrame:
    """Pattern ``(a)-[e]->(b)`` under a predicate over a and b, one row per edge."""
    return _both_ends(graph.edges, graph.vertices, F.expr(predicate)).select(
        F.col("a.id").alias("src_id"),
        F.col("b.id").alias("dst_id"),
        F.col("a.Borough").alias("Borough"),
        F.col("a.service_zone").alias("service_zone"),
    )


def motif_count(graph: Graph, predicate: str = SAME_AREA, name: str = "edge_count") -> DataFrame:
    """Number of rows of ``motif_edge``; parallel edges are folded first, so a busy pair is one row."""
    matched = _both_ends(edge_weights(graph.edges), graph.vertices, F.expr(predicate))
    return matched.agg(F.coalesce(F.sum("e.w"), F.lit(0)).alias(name))
