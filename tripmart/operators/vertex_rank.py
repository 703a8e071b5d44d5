"""PageRank with a tolerance, as rounds of DataFrame joins."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tripmart.operators.dimension import Dimension
from tripmart.operators.graph import Graph, edge_weights
from tripmart.storage import ensure_checkpoint_dir

ROUNDS_PER_CHECKPOINT = 4
#: Links of one vertex that stand in one partition; a hub has as many parts as it needs.
LINKS_PER_PART = 100_000


def pagerank(
    graph: Graph,
    reset: float = 0.15,
    tol: float = 0.01,
    *,
    checkpoint_dir: str | None = None,
    links_per_part: int = LINKS_PER_PART,
) -> DataFrame:
    """``id, pagerank`` for every vertex; the ranks sum to the number of vertices.

    Every vertex starts with rank and delta ``reset``. In each round a vertex
    whose delta exceeds ``tol`` sends it along its out-edges, split by their
    number; a receiver adds ``1 - reset`` times what it got, and that addition
    is its next delta. A vertex that received nothing sends nothing in the next
    round. The end is reached when no delta exceeds ``tol``, which must happen:
    a round passes on at most ``1 - reset`` of the deltas it sends. Edges with
    an unknown end are left out; an id listed twice is one vertex.

    Only folded edges take part, so a round costs as much as there are distinct
    pairs, not trips. Links are dealt by their source once and stay there; a
    round moves ranks and partial sums. A hub's links are dealt over several
    parts. A few rounds run between two checkpoints; a lost executor costs those
    rounds at most, and rounds past the end change nothing.
    """
    if not 0 < reset < 1 or tol <= 0:
        raise ValueError("reset must lie between 0 and 1, tol must be positive")
    spark = graph.vertices.rows.sparkSession
    ensure_checkpoint_dir(spark, checkpoint_dir)
    vertices = Dimension(graph.vertices.rows.select("id").distinct(), graph.vertices.small)
    pairs = _shares(graph, vertices).checkpoint()
    degree = pairs.groupBy("src").agg(F.ceil(F.count("*") / links_per_part).cast("int").alias("parts"))
    parts = vertices.rows.join(degree, F.col("id") == F.col("src"), "left").select(
        "id", F.coalesce("parts", F.lit(1)).alias("parts")
    )
    links = _links(pairs, parts, vertices).persist(StorageLevel.MEMORY_AND_DISK)
    links.count()  # only once they are there does a plan know how they are dealt
    start = F.lit(reset)
    ranks = parts.select("id", "parts", start.alias("rank"), start.alias("delta"))
    largest = reset
    while largest is not None and largest > tol:
        for _ in range(ROUNDS_PER_CHECKPOINT):
            ranks = _round(ranks, links, vertices.small, reset, tol)
        deltas = Observation()
        ranks = ranks.observe(deltas, F.max("delta").alias("largest")).checkpoint()
        largest = deltas.get["largest"]
    links.unpersist()
    return _scaled(ranks)


def _shares(graph: Graph, vertices: Dimension) -> DataFrame:
    """``src, dst, part``: folded edges and the share of a delta that each carries."""

    def ids(name: str) -> DataFrame:
        return vertices.side(vertices.rows.select(F.col("id").alias(name)))

    pairs = edge_weights(graph.edges).join(ids("src"), "src").join(ids("dst"), "dst")
    out = pairs.groupBy("src").agg(F.sum("w").alias("out_w"))
    return pairs.join(Dimension(out, vertices.small).side(out), "src").select(
        "src", "dst", (F.col("w") / F.col("out_w")).alias("part")
    )


def _links(pairs: DataFrame, parts: DataFrame, vertices: Dimension) -> DataFrame:
    """``src, salt, dst, part``, dealt by source and salt.

    Besides the edges there is one link from each vertex to itself. Its ``part``
    is null; by it a vertex hands its rank to the next round, so that a round is
    one join and one sum.
    """
    sources = parts.select(F.col("id").alias("src"), "parts")
    salted = pairs.join(Dimension(sources, vertices.small).side(sources), "src").select(
        "src", F.pmod(F.hash("dst"), "parts").alias("salt"), "dst", "part"
    )
    own = parts.select(
        F.col("id").alias("src"),
        F.lit(0).alias("salt"),
        F.col("id").alias("dst"),
        F.lit(None).cast("double").alias("part"),
    )
    n = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return salted.unionByName(own).repartition(n, "src", "salt")


def _round(
    ranks: DataFrame, links: DataFrame, small: bool, reset: float, tol: float
) -> DataFrame:
    senders = ranks.select(
        F.col("id").alias("src"), "parts", "rank", "delta",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"),
    )
    share = F.when(F.col("delta") > tol, F.col("delta") * F.col("part"))
    own = F.col("part").isNull()
    received = (
        links.join(Dimension(senders, small).side(senders), ["src", "salt"])
        .groupBy(F.col("dst").alias("id"))
        .agg(
            F.max(F.when(own, F.col("parts"))).alias("parts"),
            F.max(F.when(own, F.col("rank"))).alias("rank"),
            ((1 - reset) * F.sum(share)).alias("delta"),
        )
    )
    return received.withColumn("rank", F.col("rank") + F.coalesce("delta", F.lit(0.0)))


def _scaled(ranks: DataFrame) -> DataFrame:
    """Make up for what vertices without out-edges swallow."""
    size = ranks.agg(F.count("*").alias("n"), F.sum("rank").alias("sum")).first()
    factor = size["n"] / size["sum"] if size["n"] else 1.0
    return ranks.select("id", (F.col("rank") * F.lit(factor)).alias("pagerank"))
