"""Exact top-k inner products by a three-phase uniform threshold.

A score is a sum over groups of components, and each group of each block of
vectors is one score list, in order of impact: the length of the vector's part,
times that of the query's, bounds its score in the list. Phase one opens the head
of every list only; the vectors with the best scores there are resolved, and the
k-th best of all blocks is a cutoff that cannot be too high. A vector that reaches
the cutoff has at least one part that reaches the cutoff's share of one list.
Phase two sends the cutoff to every block, opens each list as far as the share can
be reached, and collects the vectors with such a part whose bound, the impact in
place of each part not opened, reaches the cutoff. Phase three resolves those.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.workers import columns, importable

LISTS = 4
BLOCK = 2048
#: Entries of a list that are opened at a time, and by phase one.
CHUNK = 256
#: Impacts are larger by this share than rounding can make them smaller.
SLACK = 1e-9
QUERY_BLOCK = 256
NO_ID = int(np.iinfo(np.int64).max)
#: As a cutoff: every vector reaches it.
LEAST = int(np.iinfo(np.int64).min)


def whole_numbers(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """``vec_id, v, n``: valid vectors as floor(scale * x), equal rows once with their number."""
    x = F.col(embedding)
    valid = x.isNotNull() & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    )
    v = F.transform(x, lambda e: F.floor(e.cast("double") * scale))
    return vectors.where(valid).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).groupBy(
        "vec_id", "v"
    ).agg(F.count("*").alias("n"))


def _packed(rows: DataFrame, size: int, dims: int, numbers: list[str]) -> DataFrame:
    """Blocks of up to ``size`` rows of a partition as arrays, numbered to be dealt out.

    Rows are in order, so that a task that runs again makes the same blocks.
    """
    importable(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() * 7919
        for batch in batches:
            for low in range(0, batch.num_rows, size):
                some = batch.slice(low, size)
                matrix = np.zeros((some.num_rows, dims), np.int64)
                v = some.column("v")
                lengths = np.diff(v.offsets.to_numpy())
                row = np.repeat(np.arange(some.num_rows), lengths)
                start = np.repeat(v.offsets.to_numpy()[:-1] - v.offsets.to_numpy()[0], lengths)
                matrix[row, np.arange(len(row)) - start] = v.flatten().to_numpy()
                part += 1
                yield columns(
                    part=pa.array([part], pa.int64()),
                    v=pa.array([matrix.tobytes()], pa.binary()),
                    **{n: pa.array([
                        some.column(n).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64).tobytes()
                    ], pa.binary()) for n in numbers},
                )

    return rows.select("v", *numbers).sortWithinPartitions(*numbers, "v").mapInArrow(
        run, "part long, v binary, " + ", ".join(f"{n} binary" for n in numbers)
    )


def _largest(a: np.ndarray) -> int:
    return max(int(a.max(initial=0)), -int(a.min(initial=0)))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of integer rows, as Python integers where a long might not hold them."""
    most = a.shape[1] * _largest(a) * _largest(b)
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    return a.astype(object) @ b.astype(object).T


def as_long(scores: np.ndarray) -> np.ndarray:
    """What a long cannot hold becomes its nearest value."""
    return np.clip(scores, LEAST, NO_ID).astype(np.int64)


class Lists:
    """The score lists of one block of vectors; ``opened`` counts scores computed in them."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors
        self.groups = np.array_split(np.arange(vectors.shape[1]), LISTS)
        self.impact = self.lengths(vectors)
        self.order = np.argsort(-self.impact, axis=0, kind="stable")
        self.opened = self.resolved = 0

    def lengths(self, rows: np.ndarray) -> np.ndarray:
        """Of each row's parts, rounded up."""
        squares = rows.astype(np.float64) ** 2
        return np.stack([np.sqrt(squares[:, g].sum(axis=1)) for g in self.groups], axis=1) * (1 + SLACK)

    def open(self, g: int, queries: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Scores in list ``g``: query, entry."""
        self.opened += len(queries) * len(entries)
        return inner(queries[:, self.groups[g]], self.vectors[np.ix_(entries, self.groups[g])])

    def whole(self, query: np.ndarray, some: np.ndarray) -> np.ndarray:
        self.resolved += len(some)
        return as_long(inner(query[None], self.vectors[some])[0])

    def heads(self, queries: np.ndarray, usable: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query the k best whole scores of what the heads of the lists bring."""
        entries = [self.order[:CHUNK, g] for g in range(LISTS)]
        scores = [self.open(g, queries, entries[g]) for g in range(LISTS)]
        for i, query in enumerate(queries):
            brought = []
            for g in range(LISTS):
                there = np.flatnonzero(usable[i, entries[g]])
                brought.append(entries[g][there[np.argsort(-scores[g][i, there], kind="stable")[:k]]])
            some = np.unique(np.concatenate(brought))
            whole = self.whole(query, some)
            best = np.argsort(-whole, kind="stable")[:k]
            yield some[best], whole[best]

    def reaching(
        self, queries: np.ndarray, usable: np.ndarray, cutoffs: list[int]
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query the vectors whose whole score is at least its cutoff, and the scores."""
        shares = [-(-cutoff // LISTS) for cutoff in cutoffs]  # some part of a sum that reaches the cutoff does
        least = np.array(shares, np.float64)
        exact = np.array(shares, object)[:, None]
        lengths = self.lengths(queries)
        bound = lengths @ self.impact.T
        slack = SLACK * bound
        reached = np.array([cutoff == LEAST for cutoff in cutoffs])[:, None].repeat(len(self.vectors), axis=1)
        for g in range(LISTS):
            for low in range(0, len(self.order), CHUNK):
                entries = self.order[low : low + CHUNK, g]
                active = np.flatnonzero(
                    (lengths[:, g] * self.impact[entries[0], g] * (1 + SLACK) >= least) & ~reached.all(axis=1)
                )
                if not len(active):
                    break
                scores = self.open(g, queries[active], entries)
                at = np.ix_(active, entries)
                known = scores.astype(np.float64)
                reached[at] |= (scores >= exact[active]).astype(bool)
                bound[at] += known - np.outer(lengths[active, g], self.impact[entries, g])
        for i, cutoff in enumerate(cutoffs):
            might = reached[i] & usable[i]
            if cutoff != LEAST:
                might &= bound[i] + slack[i] >= float(cutoff) * (1 - SLACK * np.sign(cutoff))
            some = np.flatnonzero(might)
            whole = self.whole(queries[i], some)
            yield some[whole >= cutoff], whole[whole >= cutoff]


def _blocks(batch: pa.RecordBatch, dims: int) -> Iterator[dict[str, np.ndarray]]:
    for row in batch.to_pylist():
        block = {n: np.frombuffer(b, np.int64) for n, b in row.items() if isinstance(b, bytes)}
        block["v"] = block["v"].reshape(-1, dims)
        block["qv"] = block["qv"].reshape(-1, dims)
        own = (block["q_id"][:, None] == block["vec_id"][None]) & (block["vec_id"] != NO_ID)[None]
        for i, j in np.argwhere(own):
            own[i, j] = np.array_equal(block["qv"][i], block["v"][j])
        #: copies of each vector that count for each query: one less of its own
        block["copies"] = np.broadcast_to(block["n"], own.shape) - own
        yield block


def top_k(
    vectors: DataFrame,
    *,
    k: int = 10,
    every: int = 100,
    scale: int = 1024,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows of each query.

    Queries are the rows whose id ``every`` divides, candidates all rows but the
    query's own; scores are inner products of ``floor(scale * x)``, ties go to the
    smaller id. Vectors that are null or hold nulls or non-finite numbers take no
    part; a shorter vector counts as filled up with zeros; a null id is no query
    and comes last in ties; repeated rows are candidates, and queries, each; other
    columns are not looked at; an empty table gives no rows. A score beyond a long
    is the nearest long.

    Blocks of candidates are dealt out by number; blocks of queries go to each
    of their partitions. A task holds one block of either kind at a time.
    """
    spark = vectors.sparkSession
    rows = whole_numbers(vectors, vec_id, embedding, scale)
    dims = max(LISTS, rows.agg(F.max(F.size("v"))).first()[0] or 0)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    candidates = _packed(rows, BLOCK, dims, ["vec_id", "n"]).withColumn(
        "part", F.pmod("part", F.lit(parts))
    ).repartition(parts, "part")  # a number given is kept: blocks are few bytes and much work
    within = Window.partitionBy("vec_id").orderBy("v")
    queries = rows.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id"), F.row_number().over(within).cast("long").alias("twin"), "v", "n"
    )

    def pairs(asked: DataFrame, *numbers: str) -> DataFrame:
        blocks = _packed(asked, QUERY_BLOCK, dims, ["vec_id", "twin", *numbers]).drop("part")
        sent = blocks.withColumnsRenamed({"vec_id": "q_id", "v": "qv"}).withColumn(
            "part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long")))
        )
        return candidates.join(sent.repartition(parts, "part"), "part").drop("part")

    def found_in(b: dict[str, np.ndarray], found: Iterator[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        out: dict[str, list] = {"q_id": [], "twin": [], "vec_id": [], "score": [], "copies": []}
        for i, (some, whole) in enumerate(found):
            best = np.lexsort((b["vec_id"][some], -whole))[:k]
            out["q_id"] += [b["q_id"][i]] * len(best)
            out["twin"] += [b["twin"][i]] * len(best)
            out["vec_id"] += list(b["vec_id"][some[best]])
            out["score"] += list(whole[best])
            out["copies"] += list(b["copies"][i, some[best]])
        return columns(**{n: pa.array(np.array(v, np.int64)) for n, v in out.items()})

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _blocks(batch, dims):
                yield found_in(b, Lists(b["v"]).heads(b["qv"], b["copies"] > 0, k))

    def resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in _blocks(batch, dims):
                yield found_in(b, Lists(b["v"]).reaching(b["qv"], b["copies"] > 0, b["cutoff"].tolist()))

    result = "q_id long, twin long, vec_id long, score long, copies long"
    key = ["q_id", "twin"]
    gathered = pairs(queries).mapInArrow(heads, result)
    in_order = Window.partitionBy(*key).orderBy(F.desc("score"))
    cutoffs = gathered.withColumn("place", F.row_number().over(in_order)).where(F.col("place") <= k).groupBy(
        *key
    ).agg(F.when(F.count("*") == k, F.min("score")).otherwise(F.lit(LEAST)).alias("cutoff"))
    asked = queries.join(cutoffs.withColumnRenamed("q_id", "vec_id"), ["vec_id", "twin"])
    found = pairs(asked, "cutoff").mapInArrow(resolved, result)
    best = Window.partitionBy(*key).orderBy(F.desc("score"), "vec_id")
    each = found.select(*key, "vec_id", "score", F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k)))))
    ranked = each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    asked_by = queries.select(F.col("vec_id").alias("q_id"), "twin", F.col("n").alias("asked"))
    return ranked.join(asked_by, key).select(
        F.col("q_id").alias("query_id"), "rank",
        F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id"), "score",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("asked"))).alias("copy"),
    ).drop("copy")


def op7_top_k(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP7_SQL = r"""
WITH e AS (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM e q JOIN e c ON q.vec_id % 100 = 0 AND q.r <> c.r
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 10
"""
