"""The zone graph of the trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.operators import motif_count, motif_edge, pagerank, top_k, triplets
from tripmart.operators.graph import SAME_AREA
from tripmart.plans.mart import Mart


def graph_vertices(mart: Mart) -> DataFrame:
    return mart.graph().vertices.rows


def graph_edges(mart: Mart) -> DataFrame:
    return mart.graph().edges


def graph_triplets(mart: Mart) -> DataFrame:
    return triplets(mart.graph())


def flat_triplets(mart: Mart) -> DataFrame:
    """Triplets with the struct fields as columns ``src_*``, ``edge_*`` and ``dst_*``."""
    nested = graph_triplets(mart)
    return nested.select(
        *(
            F.col(f"{part.name}.{field.name}").alias(f"{part.name}_{field.name}")
            for part in nested.schema.fields
            for field in part.dataType.fields
        )
    )


def same_area_edges(mart: Mart) -> DataFrame:
    return motif_edge(mart.graph())


def same_area_edge_count(mart: Mart, predicate: str = SAME_AREA) -> DataFrame:
    return motif_count(mart.graph(), predicate)


def pagerank_top(mart: Mart, k: int = 5, reset: float = 0.17, tol: float = 0.01) -> DataFrame:
    return top_k(pagerank(mart.graph(), reset, tol), "pagerank", ["id"], k)
