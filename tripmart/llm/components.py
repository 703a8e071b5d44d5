"""Connected components of a link table, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.workers import free
from tripmart.storage import ensure_checkpoint_dir


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a, b``); label is the least node.

    Alternating stars: a round hangs every larger neighbour of a node, then every
    smaller one, below the least neighbour, until the links are stars. A round
    sums before it shuffles and joins on the node. Rounds grow with the logarithm of the
    nodes; each is checkpointed, and the shuffle files of the one before are freed then.
    Links are stars, which a further round would leave as they are, when every node has one
    smaller neighbour at most and none has both kinds. All links of a hub meet in one task of a round.
    """
    spark = links.sparkSession
    ensure_checkpoint_dir(spark)
    edges = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    unsettled = 1
    while unsettled:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()  # every node keeps its links to smaller nodes only
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        free(spark)
        edges = small.union(low.select("a", F.col("m").alias("b"))).distinct().checkpoint()
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            edges.select("b", F.lit(0), F.lit(1))
        )
        kinds = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        unsettled = kinds.agg(F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0]
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)
