"""Removal of long word sequences that an earlier document has.

The corpus is read as a De Bruijn graph over words: an edge is a window of 13
words, and documents are paths along edges. An edge that several documents walk
is repeated; its source is the place where it starts in the document with the
least id. Edges that follow each other in a document and in their source are one
nonbranching path and are compacted into a span with source coordinates.

Only repeated edges are ever gathered. Each window has a minimizer, its least
7-word hash. Equal windows have equal minimizers, so a first join on minimizers,
about one for four words, drops the windows that can have no partner; a second
join on 128-bit window hashes finds the source of those that are left. Both
move arrays of hashes by the batch instead of rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.llm import hashing
from tripmart.llm.workers import give_back, importable

WINDOW = 13
SEED = 7
BATCH_BYTES = 4_000_000
LAST = np.iinfo(np.int64).max
SECOND = 0xD1B54A32D192ED03


class Batch:
    """Word hashes of a batch of documents, end to end, and what is derived from them."""

    def __init__(self, table: pa.Table) -> None:
        ids = table.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
        hashes, lengths = [], []
        for text in table.column("text"):
            words = hashing.split(text.as_py())
            hashes.append(hashing.word_hashes(words))
            lengths.append(len(words))
        self.hashes = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.lengths = np.array(lengths, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        row = np.repeat(np.arange(len(ids)), np.maximum(self.lengths - WINDOW + 1, 0))
        first = np.concatenate([[0], np.cumsum(np.maximum(self.lengths - WINDOW + 1, 0))])
        #: of each window: its row, document, place in the batch and place in the document
        self.row, self.doc = row, ids[row]
        self.pos = np.arange(len(row)) - first[row]
        self.at = self.pos + self.starts[row]

    def minimizers(self) -> np.ndarray:
        grams = hashing.window_hashes(self.hashes, SEED)
        n = len(self.hashes) - WINDOW + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        least = grams[:n].copy()
        for j in range(1, WINDOW - SEED + 1):
            np.minimum(least, grams[j : j + n], out=least)
        return least[self.at]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        one = hashing.window_hashes(self.hashes, WINDOW)
        two = hashing.window_hashes(self.hashes, WINDOW, SECOND)
        return (one[self.at], two[self.at]) if len(one) else (one, two)


def _runs(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal pairs together, and where each run of them starts."""
    order = np.argsort(one, kind="stable")
    a, b = one[order], two[order]
    same = a[1:] == a[:-1]
    if np.any(same & (b[1:] != b[:-1])):  # equal in the first half only: sort by both
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
        same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    return order, np.flatnonzero(np.concatenate([[True], ~same])) if len(one) else np.empty(0, np.int64)


def _sources(one, two, doc, pos) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each edge the least document that has it and the first place there; and one per edge."""
    order, starts = _runs(one, two)
    if not len(order):
        return doc, pos, np.empty(0, np.int64)
    times = np.diff(np.append(starts, len(order)))
    least = np.repeat(np.minimum.reduceat(doc[order], starts), times)
    place = np.where(doc[order] == least, pos[order], LAST)
    first = np.repeat(np.minimum.reduceat(place, starts), times)
    source_doc, source_pos = np.empty_like(doc), np.empty_like(pos)
    source_doc[order], source_pos[order] = least, first
    return source_doc, source_pos, order[starts]


def _blobs(key_name: str, keys: np.ndarray, fixed: dict, arrays: dict[str, np.ndarray]) -> pa.Table:
    """One row for each distinct key with the bytes of its part of each array."""
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    starts = np.concatenate([[0], cuts]) if len(order) else np.empty(0, np.int64)
    parts = {n: np.split(a[order], cuts) if len(order) else [] for n, a in arrays.items()}
    return pa.table({
        key_name: pa.array(keys[order][starts.astype(np.int64)], pa.int64()),
        **{n: pa.array([v] * len(starts), pa.int64()) for n, v in fixed.items()},
        **{n: pa.array([p.tobytes() for p in v], pa.binary()) for n, v in parts.items()},
    })


def _joined(table: pa.Table, name: str, dtype) -> np.ndarray:
    parts = [np.frombuffer(b.as_buffer(), dtype) for b in table.column(name)]
    return np.concatenate(parts) if parts else np.empty(0, dtype)


def _owners(table: pa.Table, name: str, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    counts = [b.as_buffer().size // size for b in table.column(name)]
    return np.repeat(table.column("batch").to_numpy(), counts)


def _seeds(table: pa.Table, buckets: int) -> pa.Table:
    """Minimizers of a batch by bucket, each once, and whether two documents have it."""
    batch = Batch(table)
    least = batch.minimizers()
    order = np.argsort(least, kind="stable")
    found, starts = np.unique(least[order], return_index=True)
    doc = batch.doc[order]
    if len(found):
        several = np.minimum.reduceat(doc, starts) < np.maximum.reduceat(doc, starts)
    else:
        several = np.empty(0, bool)
    bucket = (found % np.uint64(buckets)).astype(np.int64)
    return _blobs("bucket", bucket, {"batch": table.column("batch")[0].as_py()},
                  {"seeds": found, "several": several.astype(np.uint8)})


def _repeated_seeds(table: pa.Table) -> pa.Table:
    """Of a bucket: for each batch its minimizers that several documents have."""
    seeds = _joined(table, "seeds", np.uint64)
    batch = _owners(table, "seeds", np.uint64)
    _, inverse, times = np.unique(seeds, return_inverse=True, return_counts=True)
    several = np.bincount(inverse, _joined(table, "several", np.uint8), len(times)) > 0
    repeated = (several | (times > 1))[inverse]
    return _blobs("batch", batch[repeated], {}, {"seeds": seeds[repeated]})


def _edges(table: pa.Table, flags: pa.Table, buckets: int) -> pa.Table:
    """Edges of a batch whose minimizer is repeated, each once, with their first place."""
    batch = Batch(table)
    flagged = np.sort(_joined(flags, "seeds", np.uint64))
    least = batch.minimizers()
    if len(flagged):
        near = np.minimum(np.searchsorted(flagged, least), len(flagged) - 1)
        candidate = flagged[near] == least
    else:
        candidate = np.zeros(len(least), bool)
    one, two = (x[candidate] for x in batch.edges())
    doc, pos, once = _sources(one, two, batch.doc[candidate], batch.pos[candidate])
    once = np.sort(once)
    bucket = (one[once] % np.uint64(buckets)).astype(np.int64)
    return _blobs("bucket", bucket, {"batch": table.column("batch")[0].as_py() if len(table) else 0}, {
        "one": one[once], "two": two[once], "doc": doc[once], "pos": pos[once].astype(np.int32),
    })


def _earlier(table: pa.Table) -> pa.Table:
    """Of a bucket: for each batch the edges that an earlier document has, and their source."""
    one, two = _joined(table, "one", np.uint64), _joined(table, "two", np.uint64)
    doc, pos = _joined(table, "doc", np.int64), _joined(table, "pos", np.int32)
    batch = _owners(table, "one", np.uint64)
    source_doc, source_pos, _ = _sources(one, two, doc, pos.astype(np.int64))
    late = source_doc < doc
    return _blobs("batch", batch[late], {}, {
        "one": one[late], "two": two[late], "doc": source_doc[late],
        "pos": source_pos[late].astype(np.int32),
    })


SPAN = pa.struct([
    ("start", pa.int64()), ("n_words", pa.int64()), ("source_id", pa.int64()), ("source_start", pa.int64()),
])
RESULTS = {
    "n_words": (T.LongType(), pa.int64()),
    "n_removed": (T.LongType(), pa.int64()),
    "kept": (T.StringType(), pa.string()),
    "kept_sha256": (T.StringType(), pa.string()),
    "spans": (T.ArrayType(T.StructType([T.StructField(f.name, T.LongType()) for f in SPAN])), pa.list_(SPAN)),
}


def _cut(table: pa.Table, sources: pa.Table, results: tuple[str, ...]) -> pa.Table:
    """The documents of a batch without the words of repeated paths."""
    batch = Batch(table)
    n = len(batch.row)
    one, two = batch.edges()
    source_doc, source_pos, _ = _sources(
        np.concatenate([one, _joined(sources, "one", np.uint64)]),
        np.concatenate([two, _joined(sources, "two", np.uint64)]),
        np.concatenate([batch.doc, _joined(sources, "doc", np.int64)]),
        np.concatenate([batch.pos, _joined(sources, "pos", np.int32)]),
    )
    source_doc, source_pos = source_doc[:n], source_pos[:n]
    late = np.flatnonzero(source_doc < batch.doc)
    # compaction: a path goes on while document and source go on by one word
    goes_on = (
        (np.diff(batch.at[late]) == 1) & (np.diff(batch.row[late]) == 0)
        & (np.diff(source_doc[late]) == 0) & (np.diff(source_pos[late]) == 1)
    )
    first = late[np.concatenate([[True], ~goes_on])] if len(late) else late
    last = late[np.concatenate([~goes_on, [True]])] if len(late) else late
    size = batch.pos[last] - batch.pos[first] + WINDOW
    step = np.zeros(len(batch.hashes) + 1, np.int64)
    np.add.at(step, batch.at[first], 1)
    np.add.at(step, batch.at[first] + size, -1)
    removed = np.cumsum(step[:-1]) > 0
    spans: list[list] = [[] for _ in batch.lengths] if "spans" in results else []
    if spans:
        for r, start, count, doc, at in zip(
            batch.row[first].tolist(), batch.pos[first].tolist(), size.tolist(),
            source_doc[first].tolist(), source_pos[first].tolist(), strict=True,
        ):
            spans[r].append({"start": start, "n_words": count, "source_id": doc, "source_start": at})
    kept = []
    n_removed = np.zeros(len(batch.lengths), np.int64)
    for r, text in enumerate(table.column("text")):  # split again: the words of a batch take ten times its text
        words = hashing.split(text.as_py())
        gone = removed[batch.starts[r] : batch.starts[r + 1]]
        n_removed[r] = gone.sum()
        if n_removed[r]:
            words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
        kept.append(b" ".join(words))
    made = {
        "n_words": lambda: batch.lengths,
        "n_removed": lambda: n_removed,
        "kept": lambda: [k.decode("utf-8", "surrogatepass") for k in kept],
        "kept_sha256": lambda: [hashlib.sha256(k).hexdigest() for k in kept],
        "spans": lambda: spans,
    }
    return pa.table({
        "row": table.column("row"), **{c: pa.array(made[c](), RESULTS[c][1]) for c in results},
    })


def cut_repeats(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: list[str] | None = None,
    results: tuple[str, ...] = tuple(RESULTS),
) -> DataFrame:
    """``row`` (a struct of the columns ``carry``, the id by default) and the chosen results.

    A window of 13 consecutive words is repeated if the same words also start in a
    document with a smaller id; every word of a repeated window is removed, and
    windows are judged on the input. ``kept`` are the words left, joined by one
    blank; ``spans`` are the removed paths: first word, number of words (they may
    overlap where paths branch) and the place in the source they repeat.

    Words stand between ASCII blanks; a null text has none. A null id counts as
    larger than any other; rows with equal ids do not make each other repeated.
    Ids are integers. Documents under 13 words stay. Other columns are not looked
    at; an empty table gives no rows.

    Texts are shuffled once, by batches of about four million bytes, and that
    exchange serves the three passes. A window that a third of all documents
    have is one entry of each batch.
    """
    spark = docs.sparkSession
    importable(spark)
    carry = [doc_id] if carry is None else carry
    size = docs.agg(F.sum(F.octet_length(F.col(text)).cast("long"))).first()[0] or 0
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(2 * n_parts, int(size // BATCH_BYTES) + 1)
    dealt = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("id"),
        F.col(text).alias("text"),
        F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row"),
    ).withColumn(
        "batch", F.pmod(F.xxhash64("id", F.length("text")), F.lit(buckets)).cast("long")
    ).repartition(max(n_parts, buckets // 4), "batch")

    def seeds_of(table: pa.Table) -> pa.Table:
        return _seeds(table, buckets)

    def edges_of(table: pa.Table, flags: pa.Table) -> pa.Table:
        return _edges(table, flags, buckets)

    def cut(table: pa.Table, sources: pa.Table) -> pa.Table:
        documents = _cut(table, sources, results)
        give_back()  # groups have no end of a task
        return documents

    seeds = dealt.groupBy("batch").applyInArrow(
        seeds_of, "bucket long, batch long, seeds binary, several binary"
    )
    flags = seeds.groupBy("bucket").applyInArrow(_repeated_seeds, "batch long, seeds binary")
    edges = dealt.groupBy("batch").cogroup(flags.groupBy("batch")).applyInArrow(
        edges_of,
        "bucket long, batch long, one binary, two binary, doc binary, pos binary",
    )
    earlier = edges.groupBy("bucket").applyInArrow(
        _earlier, "batch long, one binary, two binary, doc binary, pos binary"
    )
    schema = T.StructType([
        T.StructField("row", dealt.schema["row"].dataType),
        *(T.StructField(c, RESULTS[c][0]) for c in results),
    ])
    return dealt.groupBy("batch").cogroup(earlier.groupBy("batch")).applyInArrow(cut, schema)


def without_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the kept words as text; all rows and columns, ``n_chars`` counted anew."""
    cut = cut_repeats(
        docs, doc_id=doc_id, text=text, carry=[c for c in docs.columns if c != text], results=("kept",)
    )
    values = {c: F.col(f"row.`{c}`") for c in docs.columns if c != text} | {text: F.col("kept")}
    if "n_chars" in values:
        values["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return cut.select(*(values[c].alias(c) for c in docs.columns))


def op2_substrings(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return cut_repeats(docs, results=("n_words", "n_removed", "kept_sha256")).select(
        "row.doc_id", "n_words", "n_removed", "kept_sha256"
    )


OP2_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), g AS (
  SELECT r, doc_id, k, array_to_string(words[k : k + 12], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(words) - 11)) AS k FROM d WHERE len(words) >= 13)
), late AS (
  SELECT r, k FROM (SELECT r, k, doc_id, min(doc_id) OVER (PARTITION BY gram) AS source FROM g)
  WHERE source < coalesce(doc_id, 9223372036854775807)
), gone AS (
  SELECT DISTINCT r, k + i AS k FROM late, (SELECT unnest(range(13)) AS i)
), gone_of AS (
  SELECT r, list(k) AS ks, count(*) AS n FROM gone GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN n IS NULL THEN words ELSE
    list_transform(list_filter(range(1, len(words) + 1), lambda k: NOT list_contains(ks, k)),
                   lambda k: words[k]) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone_of USING (r)
"""
