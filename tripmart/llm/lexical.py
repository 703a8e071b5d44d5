"""Ranked lexical search with MaxScore over bounds of term pairs.

Documents are cut into segments. A segment holds, for every term that queries
ask, the list of its documents with the term's occurrences, and for pairs of
terms that stand in one query their intersection with the largest joint impact.
At query time the bounds of pairs, not of terms, are combined: lists whose
combined bound stays below the cutoff never bring a document, and a document is
dropped once what it has and what may still come stay below it.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm.workers import columns, importable
from tripmart.storage import ensure_checkpoint_dir

K = 20
SEGMENT = 4096
SEGMENT_BYTES = 16 << 20
#: Queries searched at once, and bytes of their text.
QUERIES_AT_ONCE = 2000
QUERY_BYTES = 1 << 20
#: Intersections of up to this many documents are kept as lists.
SHORT = 256
HELD_WORDS = 200_000
END = b"\xff"
TERM_BYTES = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
BLANKS = bytes(b if b in TERM_BYTES else 0x20 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and other than ASCII, A-Z lowered."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(BLANKS).split()


class _Numbers(dict):
    """Numbers of the terms asked for, from 2; 0 ends a document, 1 is any other term."""

    def __init__(self, terms: list[bytes]) -> None:
        super().__init__()
        self.terms = terms
        self._begin()

    def _begin(self) -> None:
        self.clear()
        self[END] = 0
        self.update((t, i + 2) for i, t in enumerate(self.terms))

    def __missing__(self, word: bytes) -> int:
        if len(self) > len(self.terms) + HELD_WORDS:
            self._begin()
        self[word] = 1
        return 1


@dataclass(frozen=True)
class Query:
    """Term numbers, ascending by weight, how often each stands in the query, and its pairs.

    ``groups`` are (pair number, first, second) or (-1, only, -1), places in ``terms``.
    """

    terms: tuple[int, ...]
    times: tuple[int, ...]
    groups: tuple[tuple[int, int, int], ...]


def _segments(batches: Iterator[pa.RecordBatch], terms: list[bytes]) -> Iterator[pa.RecordBatch]:
    numbers = _Numbers(terms)

    def segment(ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
        words = (b" " + END + b" ").join(t.lower().translate(BLANKS) for t in [*texts, b""]).split()
        number = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        doc = np.cumsum(number == 0)
        length = np.bincount(doc[number > 0], minlength=len(texts) + 1)[: len(texts)]
        known = number > 1
        keys, tf = np.unique((number[known] - 2) << 32 | doc[known], return_counts=True)
        term, starts, df = np.unique(keys >> 32, return_index=True, return_counts=True)
        return columns(
            docs=pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            lengths=_one(length, np.int64), terms=_one(term, np.int32), df=_one(df, np.int32),
            starts=_one(starts, np.int32), at=_one(keys & 0xFFFFFFFF, np.int32), tf=_one(tf, np.int32),
        )

    for batch in batches:
        low, size, texts = 0, 0, []
        for i, text in enumerate(batch.column("text").cast(pa.binary())):
            texts.append(text.as_py())
            size += len(texts[-1])
            if len(texts) == SEGMENT or size >= SEGMENT_BYTES:
                yield segment(batch.column("doc_id").slice(low, len(texts)), texts)
                low, size, texts = i + 1, 0, []
        if texts:
            yield segment(batch.column("doc_id").slice(low, len(texts)), texts)


def _one(values, dtype) -> pa.Array:
    values = np.asarray(values).astype(dtype)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def _many(column: pa.Array) -> Iterator[np.ndarray]:
    for k in range(len(column)):
        low, high = column.offsets[k].as_py(), column.offsets[k + 1].as_py()
        yield column.values.slice(low, high - low).to_numpy(zero_copy_only=False)


#: Of a segment by pair number: the largest joint impact, and the list if it is short.
Joint = dict[int, tuple[int, np.ndarray | None]]


class Segment:
    """Impacts of a segment's postings, by term."""

    def __init__(self, lengths, terms, df, starts, at, tf, *, n: int, total: int, weight: np.ndarray) -> None:
        self.size = len(lengths)
        m = 75 + (25 * lengths.astype(np.int64) * n) // total
        tf = tf.astype(np.int64)
        impact = np.repeat(weight[terms], df) * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[at]))
        self.lists = {
            int(t): (at[s : s + d], impact[s : s + d]) for t, s, d in zip(terms, starts, df, strict=True)
        }
        self.largest = {t: int(i.max()) for t, (_, i) in self.lists.items()}

    def joint(self, a: int, b: int) -> tuple[np.ndarray, int]:
        """The documents that hold both terms, and the largest sum of the impacts there."""
        (x, xi), (y, yi) = self.lists[a], self.lists[b]
        both, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
        return both, int((xi[i] + yi[j]).max(initial=0))

    def bounds(self, query: Query, joint: Joint | None) -> list[tuple[int, list[int], int, np.ndarray | None]]:
        """The groups of terms that stand here, ascending by bound.

        Each has its bound, its places in the query, and for a pair with a list the
        bound of documents outside of it and the list.
        """
        out = []
        for pair, *places in query.groups:
            here = [p for p in places if p >= 0 and query.terms[p] in self.lists]
            if not here:
                continue
            most = [self.largest[query.terms[p]] for p in here]
            times = [query.times[p] for p in here]
            if len(here) == 2 and joint is not None:
                # in a document with one of the two, the other adds nothing
                c, listed = min(times), joint.get(pair, (0, None))
                over = sum((t - c) * m for t, m in zip(times, most, strict=True))
                apart = max(t * m for t, m in zip(times, most, strict=True))
                out.append((max(c * max(listed[0], *most) + over, apart), here, apart, listed[1]))
            else:
                out += [(t * m, [p], 0, None) for t, m, p in zip(times, most, here, strict=True)]
        return sorted(out, key=lambda g: g[:2])

    def best(self, query: Query, cutoff: int, k: int, joint: Joint | None, count: Counter):
        """Places and scores of the documents that may be among the k best at ``cutoff``."""
        groups = self.bounds(query, joint)
        held = np.cumsum([g[0] for g in groups])
        if not len(groups) or held[-1] < cutoff:
            count["segments skipped"] += 1
            return None
        first = int(np.searchsorted(held, cutoff))  # groups before it cannot reach the cutoff together
        scores = np.zeros(self.size, np.int64)
        for group in groups[first:]:
            for p in group[1]:
                at, impact = self.lists[query.terms[p]]
                scores[at] += query.times[p] * impact
        docs = np.flatnonzero(scores)
        count["scored"] += len(docs)
        for g in range(first, 0, -1):
            docs = docs[scores[docs] + held[g - 1] >= cutoff]
            bound, places, apart, listed = groups[g - 1]
            if listed is not None:
                outside = scores[docs] + (held[g - 1] - bound + apart)
                docs = docs[(outside >= cutoff) | np.isin(docs, listed)]
            for p in places:
                at, impact = self.lists[query.terms[p]]
                count["looked up"] += len(docs)
                i = np.searchsorted(at, docs)
                i[i == len(at)] = 0
                scores[docs] += np.where(at[i] == docs, query.times[p] * impact[i], 0)
        docs = docs[scores[docs] >= cutoff]
        if len(docs) > k:
            least = np.partition(scores[docs], len(docs) - k)[len(docs) - k]
            docs = docs[scores[docs] >= least]  # ties stay, ids decide later
        return docs, scores[docs]


LISTS = ("lengths", "terms", "df", "starts", "at", "tf")
PAIR_LISTS = ("pairs", "pair_most", "pair_sizes", "pair_docs")


def _joint(pairs: np.ndarray, most: np.ndarray, sizes: np.ndarray, docs: np.ndarray) -> Joint:
    kept = np.where(sizes <= SHORT, sizes, 0)
    high = np.cumsum(kept)
    return {
        p: (m, docs[h - n : h] if n == size else None)
        for p, m, n, size, h in zip(pairs.tolist(), most.tolist(), kept.tolist(), sizes.tolist(), high.tolist(), strict=True)
    }


def _paired(batches: Iterator[pa.RecordBatch], pairs: list[tuple[int, int]], stats: dict) -> Iterator[pa.RecordBatch]:
    """Adds to each segment its term-pair lists: the intersections and their largest joint impacts."""
    for batch in batches:
        for k, lists in enumerate(zip(*(_many(batch.column(c)) for c in LISTS), strict=True)):
            segment = Segment(*lists, **stats)
            number, most, sizes, docs = [], [], [], [np.empty(0, np.int64)]
            for i, (a, b) in enumerate(pairs):
                if a in segment.lists and b in segment.lists:
                    both, joint = segment.joint(a, b)
                    number.append(i)
                    most.append(joint)
                    sizes.append(len(both))
                    docs += [both] * (len(both) <= SHORT)
            yield columns(
                **{c: batch.column(c).slice(k, 1) for c in ("docs", *LISTS)},
                pairs=_one(number, np.int32), pair_most=_one(most, np.int64),
                pair_sizes=_one(sizes, np.int32), pair_docs=_one(np.concatenate(docs), np.int32),
            )


def _found(
    batches: Iterator[pa.RecordBatch], queries: list[Query], cutoffs: np.ndarray, k: int, stats: dict, seeds: bool
) -> Iterator[pa.RecordBatch]:
    """The k best of each query in a partition, in ``seeds`` those of its first segment."""
    held: list[list[tuple]] = [[] for _ in queries]
    cutoffs, count, done = cutoffs.copy(), Counter(), False
    kind = pa.int64()
    for batch in batches:
        kind = batch.column("docs").type.value_type
        for s, lists in enumerate(zip(*(_many(batch.column(c)) for c in LISTS), strict=True)):
            if done and seeds:
                break
            done = True
            segment = Segment(*lists, **stats)
            joint = _joint(*(batch.column(c)[s].values.to_numpy() for c in PAIR_LISTS))
            ids = batch.column("docs")[s].values
            for q, query in enumerate(queries):
                found = segment.best(query, int(cutoffs[q]), k, joint, count)
                if found is None or not len(found[0]):
                    continue
                held[q] += zip(found[1].tolist(), ids.take(pa.array(found[0])).to_pylist(), strict=True)
                if len(held[q]) >= k:
                    held[q].sort(key=lambda r: (-r[0], r[1] is None, r[1]))
                    del held[q][k:]
                    cutoffs[q] = max(cutoffs[q], held[q][-1][0])
    flat = [(q, score, doc) for q, rows in enumerate(held) for score, doc in rows]
    yield columns(
        query=pa.array([q for q, _, _ in flat], pa.int32()), score=pa.array([s for _, s, _ in flat], pa.int64()),
        doc_id=pa.array([d for _, _, d in flat], kind),
    )


def _block(docs: DataFrame, asked: list[list[bytes]], k: int) -> DataFrame:
    """``query, score, doc_id``: k documents at most for each of the queries."""
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    terms = sorted({t for q in asked for t in q})
    lists = "lengths array<long>, terms array<int>, df array<int>, starts array<int>, at array<int>, tf array<int>"
    index = docs.mapInArrow(partial(_segments, terms=terms), f"docs array<{kind}>, {lists}").checkpoint()
    n, total = index.agg(
        F.sum(F.size(F.filter("lengths", lambda x: x > 0))), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))
    ).first()
    df = np.zeros(len(terms), np.int64)
    for r in index.select(F.inline(F.arrays_zip("terms", "df"))).groupBy("terms").agg(F.sum("df").alias("df")).collect():
        df[r["terms"]] = r["df"]  # a row for each term asked
    weight = np.array([math.floor(1000 * math.log((2 * (n or 0) + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    stats = {"n": n or 0, "total": max(total or 0, 1), "weight": weight}
    number = {t: i for i, t in enumerate(terms)}
    pairs: dict[tuple[int, int], int] = {}
    queries = []
    for q in asked:
        times = Counter(number[t] for t in q)
        mine = sorted((t for t in times if df[t]), key=lambda t: (weight[t], t))
        groups = []
        for i in range(0, len(mine), 2):
            if i + 1 == len(mine):
                groups.append((-1, i, -1))
            else:
                groups.append((pairs.setdefault((mine[i], mine[i + 1]), len(pairs)), i, i + 1))
        queries.append(Query(tuple(mine), tuple(times[t] for t in mine), tuple(groups)))
    index = index.mapInArrow(
        partial(_paired, pairs=list(pairs), stats=stats),
        f"docs array<{kind}>, {lists}, pairs array<int>, pair_most array<long>, pair_sizes array<int>, pair_docs array<int>",
    ).checkpoint()

    def found(cutoffs: np.ndarray, seeds: bool) -> DataFrame:
        return index.mapInArrow(
            partial(_found, queries=queries, cutoffs=cutoffs, k=k, stats=stats, seeds=seeds),
            f"query int, score long, doc_id {kind}",
        )

    # k-th best score of what the first segments bring: no better document is below it
    order = Window.partitionBy("query").orderBy(F.desc("score"))
    cutoffs = np.ones(len(queries), np.int64)
    first = found(cutoffs, seeds=True).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    for r in first.groupBy("query").agg(F.min("score").alias("score"), F.count("*").alias("n")).collect():
        if r["n"] == k:
            cutoffs[r["query"]] = r["score"]
    return found(cutoffs, seeds=False)


def search(
    docs: DataFrame, items: DataFrame, *, k: int = K, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k documents of highest score above 0 for each item.

    The score is exact (see ``Segment``); equal ones rank by ascending id, null
    ids last. Null and empty texts have no terms, so that an item without terms
    gets no rows; equal rows of ``items`` are one query, equal documents are as many
    documents; other columns are not looked at; an empty table gives no rows. A very
    long text is a segment of its own. Items go through in blocks of bounded size,
    each of which reads ``docs`` once; what a block sends to tasks is its terms and
    pairs, a few MB.
    """
    spark = docs.sparkSession
    importable(spark)
    ensure_checkpoint_dir(spark)
    source = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")
    )
    asked = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").alias("text")).distinct()
    kind = asked.schema["item_id"].dataType.simpleString()
    out, block, size = [], [], 0

    def searched() -> None:
        ids = spark.createDataFrame([(i, b[0]) for i, b in enumerate(block)], f"query int, item_id {kind}")
        out.append(_block(source, [b[1] for b in block], k).join(F.broadcast(ids), "query"))

    for r in asked.orderBy("item_id", "text").toLocalIterator():
        terms = terms_of(r["text"])
        if not terms:
            continue
        block.append((r["item_id"], terms))
        size += len(r["text"])
        if len(block) == QUERIES_AT_ONCE or size >= QUERY_BYTES:
            searched()
            block, size = [], 0
    if block:
        searched()
    if not out:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id {source.schema['doc_id'].dataType.simpleString()}, score long")
    ranked = []
    for found in out:
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked.append(
            found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score")
        )
    whole = ranked[0]
    for more in ranked[1:]:
        whole = whole.unionAll(more)
    return whole


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP11_SQL = r"""
WITH lowered AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), totals AS (
  SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM lowered WHERE len(terms) > 0
), docs AS (
  SELECT row, doc_id, terms, 75 + (25 * len(terms)::BIGINT * n_docs) // n_terms AS m
  FROM lowered, totals WHERE len(terms) > 0
), postings AS (
  SELECT row, doc_id, m, term, count(*) AS tf
  FROM (SELECT row, doc_id, m, unnest(terms) AS term FROM docs) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, totals GROUP BY term, n_docs
), asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL
), scored AS (
  SELECT item_id, row, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""
