"""Mix the sources of a corpus to target weights by systematic sampling.

Every document of a source has the same expected number of copies, the source's
target over its size. Documents are put in one order, the expected copies are
summed along it, a random offset is added, and a document is emitted once for
every integer boundary that its step crosses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
PATH = ("step", "b1", "b2")


def word_count(text: Column) -> Column:
    """Words between ASCII blanks; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(
    sizes: DataFrame, *, weights: tuple[int, ...] = (1, 2, 3), cap: int = 3
) -> DataFrame:
    """``src, source_size, target`` from ``src, no_source, source, source_size``.

    Sources in code point order, null last, take the weights in turn and share
    the sum of all sizes. A target stops at ``cap`` times its source's size and
    the excess goes to the others by weight, until none is above: in the order
    of cap over weight a source is capped when its cap is at most its share of
    what the sources before it leave. One row per source meets in one task.
    """
    by_name = Window.orderBy("no_source", "source")
    weight = F.element_at(
        F.array(*(F.lit(w) for w in weights)),
        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"),
    )
    weighted = sizes.withColumn("w", weight.cast("long")).withColumn(
        "cap", cap * F.col("source_size")
    )
    fill = Window.orderBy(F.col("cap") / F.col("w"), "no_source", "source")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    left_w = F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0))
    at_cap = F.col("cap").cast("double") * left_w <= F.col("w").cast("double") * left
    capped = weighted.withColumn("at_cap", at_cap)
    free = F.sum("source_size").over(everything) - F.sum(
        F.when(F.col("at_cap"), F.col("cap")).otherwise(0)
    ).over(everything)
    free_w = F.sum(F.when(F.col("at_cap"), 0).otherwise(F.col("w"))).over(everything)
    share = (free.cast("double") * F.col("w")) / free_w
    target = F.when(F.col("at_cap"), F.col("cap").cast("double")).otherwise(share)
    return capped.select("src", "source_size", target.alias("target"))


def mixing_plan(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    cap: int = 3,
    seed: int = 42,
    carry: bool = False,
) -> DataFrame:
    """``doc_id, size, source_size, target, copies, taken`` for every row of ``docs``.

    ``size`` counts words, ``taken`` is copies times size. ``carry`` adds the
    input row as struct ``row``. A null text is a document of size 0, a null
    source is a source of its own, null ids and repeated rows are documents like
    others, other columns are not looked at. An empty table gives no rows.

    The order within a source is by size to four binary digits, then by two
    bytes of the id's MD5, then by size and id. So neighbours have like sizes
    and words come near the target as documents do. Prefix sums are taken level
    by level over counts: a window holds one source's sizes, or 256 buckets, and
    row numbers are only needed within a bucket, however many rows a source has.
    """
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    size = word_count(F.col(text))
    picked = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("src"),
        F.col(source).alias("source"),
        size.alias("size"),
        digest.alias("digest"),
        F.xxhash64(F.col(text)).alias("tie"),
        *([F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if carry else []),
    )
    keyed = picked.withColumns({
        "step": F.expr("length(bin(size)) * 16 + shiftright(size, greatest(length(bin(size)) - 4, 0))"),
        "b1": F.substring("digest", 1, 2),
        "b2": F.substring("digest", 3, 2),
    }).drop("digest")
    counts = keyed.groupBy("src", *PATH).agg(
        F.count("*").alias("n"), F.sum("size").alias("s"), F.first("source").alias("source")
    )
    sizes = counts.groupBy("src").agg(
        F.sum("s").alias("source_size"), F.first("source").alias("source")
    ).withColumn("no_source", F.col("source").isNull())
    hexed = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("src"))), 1, 8)
    starts = targets(sizes, weights=weights, cap=cap).withColumns({
        "rate": F.coalesce(
            F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0)
        ),
        "offset": F.conv(hexed, 16, 10).cast("double") / F.lit(4294967296.0),
        "start": F.lit(0).cast("long"),
    })
    for depth in range(len(PATH)):
        path = [*PATH[: depth + 1]]
        before = (
            Window.partitionBy("src", *path[:-1]).orderBy(path[-1])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        level = counts.groupBy("src", *path).agg(F.sum("n").alias("n")).select(
            "src", *path, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")
        )
        starts = starts.join(level, ["src", *path[:-1]]).withColumn(
            "start", F.col("start") + F.col("before")
        ).drop("before")
    within = Window.partitionBy("src", *PATH).orderBy("size", "doc_id", "tie")
    ranked = keyed.drop("source").join(starts, ["src", *PATH]).withColumn(
        "rank", F.col("start") + F.row_number().over(within)
    )

    def reached(rank: Column) -> Column:
        return F.floor(rank * F.col("rate") + F.col("offset"))

    copies = (reached(F.col("rank")) - reached(F.col("rank") - 1)).cast("long")
    return ranked.withColumn("copies", copies).select(
        "doc_id", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
        *(["row"] if carry else []),
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    plan = mixing_plan(docs, carry=True, **options).where("copies > 0")
    return plan.select(F.explode(F.sequence(F.lit(1).cast("long"), "copies")), "row").select("row.*")


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mixing_plan(docs).select("doc_id", "size", "source_size", "target", "taken")


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS src,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents
), s AS (
  SELECT src, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM d GROUP BY src
), w AS (
  SELECT *, 3 * source_size AS cap,
    1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS w FROM s
), f AS (
  SELECT *,
    sum(source_size) OVER () - coalesce(sum(cap) OVER fill, 0) AS left_s,
    sum(w) OVER () - coalesce(sum(w) OVER fill, 0) AS left_w
  FROM w
  WINDOW fill AS (ORDER BY cap / w, source IS NULL, source
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (
  SELECT *, cap::DOUBLE * left_w <= w::DOUBLE * left_s AS at_cap FROM f
), t AS (
  SELECT src, source_size, CASE WHEN at_cap THEN cap::DOUBLE ELSE
    ((sum(source_size) OVER () - sum(CASE WHEN at_cap THEN cap ELSE 0 END) OVER ())::DOUBLE * w)
    / (sum(CASE WHEN at_cap THEN 0 ELSE w END) OVER ())::DOUBLE END AS target,
    ('0x' || substr(md5('42:' || src), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM c
), r AS (
  SELECT doc_id, size, source_size, target, u,
    CASE WHEN source_size > 0 THEN target / source_size::DOUBLE ELSE 0.0::DOUBLE END AS rate,
    row_number() OVER (PARTITION BY src ORDER BY
      length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)),
      substr(digest, 1, 2), substr(digest, 3, 2), size, doc_id) AS k
  FROM d JOIN t USING (src)
)
SELECT doc_id, size, source_size, target,
  ((floor(k * rate + u) - floor((k - 1) * rate + u))::BIGINT * size)::BIGINT AS taken
FROM r
"""
