from __future__ import annotations

import re
import subprocess
import sys
from collections import Counter
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from tripmart.operators import (
    Dimension,
    Graph,
    edge_weights,
    motif_count,
    motif_edge,
    pagerank,
    triplets,
    zone_vertices,
)
from tripmart.operators import vertex_rank
from tripmart.plans import Mart

VERTICES = [
    (1, "North", "One", "Boro"),
    (2, "North", "Two", "Boro"),
    (3, "South", "Three", "Boro"),
    (4, "South", "Four", ""),
    (5, "South", "Five", ""),
]
# three parallel edges, a self-loop, a sink (4), a vertex without edges (5), an unknown end (9)
EDGES = [(1, 2), (1, 2), (1, 2), (2, 2), (3, 4), (2, 1), (1, 9), (9, 1)]

SCHEMA = "id int, Borough string, Zone string, service_zone string"


def graph(spark, edges, small=True, vertices=VERTICES):
    frame = spark.createDataFrame(vertices, SCHEMA)
    return Graph(Dimension(frame, small), spark.createDataFrame(edges, "src int, dst int"))


def plain_ranks(ids, edges, reset, tol):
    """The rounds as loops over edges, one by one."""
    edges = [(s, d) for s, d in edges if s in ids and d in ids]
    out = Counter(s for s, _ in edges)
    rank = dict.fromkeys(ids, reset)
    delta: dict = dict.fromkeys(ids, reset)
    while True:
        inbox: dict = {}
        for s, d in edges:
            if delta.get(s) is not None and delta[s] > tol:
                inbox[d] = inbox.get(d, 0.0) + delta[s] / out[s]
        if not inbox:
            break
        delta = {d: (1 - reset) * m for d, m in inbox.items()}
        for d, gain in delta.items():
            rank[d] += gain
    factor = len(ids) / sum(rank.values())
    return {v: r * factor for v, r in rank.items()}


def same_ranks(found, wanted):
    got = {r.id: r.pagerank for r in found.collect()}
    assert got.keys() == wanted.keys()
    assert all(got[v] == pytest.approx(wanted[v], abs=1e-9) for v in wanted)


def test_vertices_from_zones(spark):
    zones = spark.createDataFrame(VERTICES, SCHEMA.replace("id", "LocationID", 1))
    assert rows(zone_vertices(zones)) == sorted(VERTICES, key=repr)


def test_weights(spark):
    assert rows(edge_weights(graph(spark, EDGES).edges))[0] == (1, 2, 3)


@pytest.mark.parametrize("small", [True, False])
def test_triplets_are_the_distinct_joined_rows(spark, small):
    g = graph(spark, EDGES, small, [*VERTICES, VERTICES[0]])
    v = g.vertices.rows
    joined = (
        g.edges.alias("e")
        .join(v.alias("a"), F.col("e.src") == F.col("a.id"))
        .join(v.alias("b"), F.col("e.dst") == F.col("b.id"))
        .select(
            F.struct("a.*").alias("src"),
            F.struct("e.*").alias("edge"),
            F.struct("b.*").alias("dst"),
        )
        .distinct()
    )
    assert rows(triplets(g)) == rows(joined)
    assert triplets(g).count() == 4


@pytest.mark.parametrize("small", [True, False])
def test_motif_counts_every_parallel_edge_and_self_loop(spark, small):
    g = graph(spark, EDGES, small)
    assert rows(motif_edge(g)) == sorted(
        [(1, 2, "North", "Boro")] * 3 + [(2, 2, "North", "Boro"), (2, 1, "North", "Boro")],
        key=repr,
    )
    assert rows(motif_count(g)) == [(5,)]
    assert rows(motif_count(g, "a.id > 100")) == [(0,)]


def test_blank_service_zones_are_equal(spark):
    assert rows(motif_count(graph(spark, [(4, 5), (3, 4)]))) == [(1,)]


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("links_per_part", [100_000, 1])
def test_pagerank_of_the_hand_graph(spark, small, links_per_part):
    doubled = [*VERTICES, VERTICES[0]]  # an id listed twice is one vertex
    ranks = pagerank(graph(spark, EDGES, small, doubled), 0.17, 0.01, links_per_part=links_per_part)
    same_ranks(ranks, plain_ranks({1, 2, 3, 4, 5}, EDGES, 0.17, 0.01))
    assert ranks.agg(F.sum("pagerank")).first()[0] == pytest.approx(5)


def test_a_round_moves_no_links(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    vertices = Dimension(spark.createDataFrame([(1, 1), (2, 1)], "id int, parts int"), False)
    pairs = spark.createDataFrame([(1, 2, 1.0)], "src int, dst int, part double")
    links = vertex_rank._links(pairs, vertices.rows, vertices).persist()
    links.count()
    ranks = vertices.rows.withColumns({"rank": F.lit(0.2), "delta": F.lit(0.2)})
    for _ in range(2):
        ranks = vertex_rank._round(ranks, links, False, 0.2, 0.01)
    # one exchange a round by source and salt, for the ranks; the links stay
    moved = re.findall(r"hashpartitioning\(src#\d+, salt#\d+, \d+\), ENSURE_REQUIREMENTS", plan(ranks))
    assert len(moved) == 2 and "InMemoryTableScan" in plan(ranks)
    assert ranks.count() == 2
    links.unpersist()


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 7), st.integers(0, 7)), max_size=30), st.booleans())
def test_pagerank_of_any_graph(spark, edges, small):
    vertices = [(i, "", "", "") for i in [*range(7), 3]]
    ranks = pagerank(graph(spark, edges, small, vertices), 0.2, 0.05, links_per_part=2)
    same_ranks(ranks, plain_ranks(set(range(7)), edges, 0.2, 0.05))


def test_pagerank_without_edges_or_rounds(spark):
    flat = {v[0]: 1.0 for v in VERTICES}
    same_ranks(pagerank(graph(spark, []), 0.17, 0.01), flat)
    same_ranks(pagerank(graph(spark, EDGES), 0.17, 0.5), flat)


@pytest.mark.parametrize(("reset", "tol"), [(0, 0.1), (1, 0.1), (0.2, 0)])
def test_pagerank_refuses_rounds_without_end(spark, reset, tol):
    with pytest.raises(ValueError, match="reset"):
        pagerank(graph(spark, EDGES), reset, tol)


SHARED_FOLDER_JOB = """
import sys
from pyspark.sql import SparkSession
from tripmart.operators import Dimension, Graph, pagerank

builder = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
spark = builder.config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
vertices = spark.createDataFrame([(1,), (2,)], "id int")
edges = spark.createDataFrame([(1, 2)], "src int, dst int")
print(pagerank(Graph(Dimension(vertices, True), edges), 0.17, 0.1).count())
"""


def test_checkpoints_go_where_the_session_says(tmp_path):
    root = Path(__file__).resolve().parent.parent
    command = [sys.executable, "-c", SHARED_FOLDER_JOB, str(tmp_path / "shared")]
    done = subprocess.run(command, cwd=root, capture_output=True, text=True, timeout=120)
    assert done.stdout.strip() == "2"
    assert list((tmp_path / "shared").glob("*/rdd-*"))


def test_two_dimensions_are_one_id_space(spark):
    zones = "LocationID int, Borough string, Zone string, service_zone string"
    suppliers = spark.createDataFrame([(1, "x", "S1", ""), (2, "y", "S2", "")], zones)
    customers = spark.createDataFrame([(1, "x", "C1", ""), (3, "y", "C3", "")], zones)
    trips = spark.createDataFrame(
        [(1, 1, 1), (2, 3, 1), (1, 1, 1)], "pickup_location int, dropoff_location int, month int"
    )
    g = Mart.of(trips, suppliers, customers).graph()
    assert {r.id for r in g.vertices.rows.collect()} == {"pickup:1", "pickup:2", "dropoff:1", "dropoff:3"}
    assert sorted((r.src.Zone, r.dst.Zone) for r in triplets(g).collect()) == [("S1", "C1"), ("S2", "C3")]
    assert motif_count(g, "a.Borough = b.Borough").first()[0] == 3
