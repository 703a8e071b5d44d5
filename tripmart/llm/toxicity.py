"""Toxicity by the nearest labelled examples.

Examples and documents are TF-IDF vectors over all words of the examples, the more
telling of the label the heavier. A block-max inverted index of the examples finds the k nearest by exact
cosine: blocks whose bound cannot reach the k-th best are never opened. Votes
weighted by closeness, calibrated on examples that vote without themselves, give
the score, the nearest examples are the evidence.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.hashing import Numbers, byte_values, spellings
from tripmart.llm.lexical import BLANKS, TERM_BYTES
from tripmart.llm.workers import columns, free, importable, lean, map_batches
from tripmart.storage import ensure_checkpoint_dir

THRESHOLD = 0.3
#: Beside whole words, their first letters are terms where these tell the labels apart.
BEGINNINGS = (4, 5, 6)
#: Weight of a term that tells nothing, against one whose chi-square is ``TELLING`` or more.
PLAIN, TELLING = 0.1, 20.0
#: A vote at the overall rate, so that far neighbours alone say little.
REST = 0.01
#: Bytes of the texts scored at once, and of those whose words are found at once, so that arrays stay in cache.
CHUNK, PIECE = 800_000, 120_000
VALUES, SEPARATOR = byte_values(TERM_BYTES), re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
#: Vectors of a block of the index.
PER_BLOCK = 64
#: Queries of one product with the long lists, and postings of the short lists of those looked at together.
QUERIES, POSTINGS = 64, 400_000
#: More than what sums of 32 bits are off by.
ROUNDING = 1e-5


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learnt from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers from each ``low`` to its ``high``, end to end."""
    n = high - low
    return np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n)


@dataclass
class BlockMaxIndex:
    """Postings of unit vectors by term, in runs of one block each, with the run's largest weight.

    ``ids`` and ``weights`` are the postings in order of term, then vector. The runs
    of term t are ``first[t]`` to ``first[t + 1]``; run r lies in block ``block[r]``, its
    postings from ``at[r]`` to ``at[r + 1]``.
    """

    size: int
    blocks: int
    ids: np.ndarray
    weights: np.ndarray
    first: np.ndarray
    block: np.ndarray
    at: np.ndarray
    largest: np.ndarray

    @classmethod
    def of(cls, vector: np.ndarray, term: np.ndarray, weight: np.ndarray, size: int, terms: int):
        order = np.lexsort((vector, term))
        vector, term, weight = vector[order], term[order], weight[order].astype(np.float64)
        block = vector // PER_BLOCK
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (block[1:] != block[:-1])
        at = np.flatnonzero(new)
        first = np.searchsorted(term[at], np.arange(terms + 1))
        largest = np.maximum.reduceat(weight, at) if len(at) else np.empty(0)
        return cls(size, -(-size // PER_BLOCK), vector.astype(np.int32), weight, first, block[at].astype(np.int32),
                   np.append(at, len(term)).astype(np.int32), largest)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("row", "rows", "per_block")}

    def _long(self) -> None:
        """Lists of more than a sixteenth of the vectors as rows of all vectors, filled with zeros."""
        starts = self.at[self.first]
        n = np.diff(starts)
        self.per_block = PER_BLOCK
        long = np.flatnonzero(n * 16 > self.size)
        self.row = np.full(len(n), -1, np.int32)
        self.row[long] = np.arange(len(long))
        self.rows = np.zeros((len(long), self.blocks * self.per_block), np.float32)
        for i, t in enumerate(long.tolist()):
            own = slice(starts[t], starts[t + 1])
            self.rows[i, self.ids[own]] = self.weights[own]

    def nearest(
        self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1, opened: list | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """The k vectors of largest positive cosine and those, ties to the lower number; ``without`` takes no part."""
        return self.nearest_each(terms, weights, np.array([0, len(terms)]), k, np.array([without]), opened)[0]

    def nearest_each(
        self, terms: np.ndarray, weights: np.ndarray, edges: np.ndarray, k: int,
        without: np.ndarray | None = None, opened: list | None = None,
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` for queries whose terms lie between ``edges``.

        Some at a time, so that arrays stay small: a query alone has no more postings than the index.
        Long lists are added up for all vectors, for all queries in one product.
        """
        n = len(edges) - 1
        if not self.size:
            return [(np.empty(0, np.int64), np.empty(0))] * n
        if not hasattr(self, "rows"):
            self._long()
        without = np.full(n, -1) if without is None else without
        row, lists = self.row[terms], self.at[self.first]
        postings = np.append(0, np.cumsum(np.where(row < 0, lists[terms + 1] - lists[terms], 0)))[edges]
        out = []
        for begin in range(0, n, QUERIES):
            end = min(n, begin + QUERIES)
            own = slice(edges[begin], edges[end])
            query, long = np.repeat(np.arange(end - begin), np.diff(edges[begin : end + 1])), row[own] >= 0
            asked = np.zeros((end - begin, len(self.rows)), np.float32)
            asked[query[long], row[own][long]] = weights[own][long]
            product, low = asked @ self.rows, begin
            while low < end:
                high = int(np.searchsorted(postings, postings[low] + POSTINGS, "right")) - 1
                high = min(end, max(high, low + 1))
                own = slice(edges[low], edges[high])
                out += self._nearest(terms[own], weights[own], row[own], edges[low : high + 1] - edges[low],
                                     product[low - begin : high - begin], k, without[low:high], opened)
                low = high
        return out

    def _nearest(self, terms, weights, row, edges, scores, k, without, opened) -> list[tuple[np.ndarray, np.ndarray]]:
        """The nearest where ``scores`` are what the long lists give.

        These bound a block together with the largest weights of its runs; runs of blocks that
        cannot reach the k-th best stay shut. The product's rounding depends on the queries in it, so all
        within ``ROUNDING`` of the k-th best are added up again for their query alone before they are ranked.
        """
        queries, width = len(edges) - 1, self.blocks * self.per_block
        some = np.flatnonzero(without >= 0)
        scores[some, without[some]] = 0
        long = row >= 0
        query, short, weight = np.repeat(np.arange(queries), np.diff(edges))[~long], terms[~long], weights[~long]
        n = self.first[short + 1] - self.first[short]
        runs, weight = _ranges(self.first[short], self.first[short + 1]), np.repeat(weight, n)
        query = np.repeat(query, n)
        block = query * self.blocks + self.block[runs]
        bounds = np.bincount(block, weight * self.largest[runs], minlength=queries * self.blocks).reshape(queries, -1)
        bounds = bounds + scores.reshape(queries, self.blocks, -1).max(axis=2)
        # the most promising blocks give a cutoff, then all others that can reach it are opened
        some, done = np.zeros(bounds.shape, bool), np.zeros(bounds.shape, bool)
        np.put_along_axis(some, np.argsort(-bounds, axis=1, kind="stable")[:, : max(2, -(-2 * k // self.per_block))], True, 1)
        cutoff, added = np.zeros(queries), np.zeros((queries, width))
        for _ in range(2):
            here = np.flatnonzero((some & ~done).reshape(-1)[block])
            own = runs[here]
            low, high = self.at[own], self.at[own + 1]
            places = _ranges(low, high)
            added += np.bincount(
                np.repeat(query[here] * width, high - low) + self.ids[places],
                self.weights[places] * np.repeat(weight[here], high - low), minlength=added.size,
            ).reshape(added.shape)
            done |= some
            whole = added + scores
            whole.reshape(queries, self.blocks, -1)[~done] = 0
            for q in np.flatnonzero(without >= 0):
                whole[q, without[q]] = 0
            if width > k:
                cutoff = np.partition(whole, width - k, axis=1)[:, width - k]
            some = (bounds >= cutoff[:, None] - ROUNDING) & (bounds > 0)
            if not (some & ~done).any():
                break
        if opened is not None:
            opened += done.sum(axis=1).tolist()
        out = []
        for q, (low, high) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
            best = np.flatnonzero((whole[q] >= cutoff[q] - ROUNDING) & (whole[q] > 0))
            own = long[low:high]
            # whole blocks, which products take alike wherever a vector stands
            whole_blocks = np.resize(best, -(-len(best) // self.per_block) * self.per_block)
            again = weights[low:high][own].astype(np.float32) @ self.rows[row[low:high][own, None], whole_blocks]
            exact = added[q, best] + again[: len(best)]
            order = np.lexsort((best, -exact))[:k]
            out.append((best[order], exact[order]))
        return out


class Terms:
    """Numbers of the terms in texts: the words, then the beginnings of longer words.

    Words are looked up by 64 bits that their bytes give: that two are equal rests on these.
    """

    def __init__(self, words: list[bytes], beginnings: list[str]) -> None:
        self.lengths, self.size = sorted({len(b) for b in beginnings}), len(words) + len(beginnings)
        self.words = Numbers(self._hashes(words))
        self.beginnings = Numbers(self._hashes([b.encode("utf-8", "surrogatepass") for b in beginnings]), len(words))

    @staticmethod
    def _hashes(words: list[bytes]) -> np.ndarray:
        parts = [np.empty(0, np.uint64)]
        for low in range(0, len(words), 10_000):
            parts.append(spellings(np.frombuffer(b" ".join(words[low : low + 10_000]), np.uint8), VALUES, [])[1])
        return np.concatenate(parts)

    def counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms of each text, ascending, how often each occurs, and where each text's begin."""
        joined = b" ".join(texts)
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
        keys, low = [np.empty(0, np.int64)], 0
        while low < len(joined):
            high = len(joined)
            if high - low > PIECE:  # up to the next blank, or a very long word's end
                blank = SEPARATOR.search(joined, low + PIECE)
                high = blank.start() if blank else high
            starts, words, longer = spellings(np.frombuffer(joined, np.uint8, high - low, low), VALUES, self.lengths)
            text = (np.searchsorted(begins, starts + low, "right") - 1) * self.size
            for own, number in ((slice(None), self.words(words)), *((i, self.beginnings(b)) for i, b in longer)):
                known = number >= 0
                keys.append(text[own][known] + number[known])
            low = high
        keys, times = np.unique(np.concatenate(keys), return_counts=True)
        return keys % max(self.size, 1), times, np.searchsorted(keys, np.arange(len(texts) + 1) * self.size)


@dataclass
class Model:
    """Terms and their weights, the index, labels and weights of its examples, and the calibration."""

    words: list[bytes]
    beginnings: list[str]
    weight: np.ndarray
    index: BlockMaxIndex
    label: np.ndarray
    stands_for: np.ndarray
    example_id: list
    rate: float
    k: int
    slope: float = 1.0
    offset: float = 0.0
    terms: Terms | None = field(default=None, repr=False)

    def __post_init__(self) -> None:
        self.terms = self.terms or Terms(self.words, self.beginnings)
        self.rest = REST * self.stands_for.mean() if len(self.stands_for) else 0.0

    def to_send(self) -> Model:
        """The model without the spelling of its words, which no score needs."""
        return replace(self, words=[])

    def flat(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms and weights of the unit vectors of all texts, and where each text's begin."""
        terms, times, edges = self.terms.counts(texts)
        weights = (1 + np.log(times)) * self.weight[terms]
        text = np.repeat(np.arange(len(texts)), np.diff(edges))
        return terms, weights / np.sqrt(np.bincount(text, weights**2, minlength=len(texts)))[text], edges

    def vectors(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        terms, weights, edges = self.flat(texts)
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield terms[low:high], weights[low:high]

    def odds(self, ids: np.ndarray, near: np.ndarray) -> float:
        """Log-odds of the votes of the nearest examples."""
        votes = near**3 * self.stands_for[ids]
        share = float((votes @ self.label[ids] + self.rest * self.rate) / (votes.sum() + self.rest))
        share = min(max(share, 1e-6), 1 - 1e-6)
        return math.log(share / (1 - share))

    def score(self, terms: np.ndarray, weights: np.ndarray) -> tuple[float, list[dict]]:
        if not len(terms) or not 0 < self.rate < 1:
            return self.rate, []
        ids, near = self.index.nearest(terms, weights, self.k)
        return self._judged(ids, near), self._evidence(ids, near)

    def scores(self, texts: list[bytes], evidence: bool = False) -> tuple[list[float], list[list[dict]]]:
        """Scores of all texts; where asked for, what each rests on."""
        if not 0 < self.rate < 1:
            return [self.rate] * len(texts), [[] for _ in texts] if evidence else []
        found = self.index.nearest_each(*self.flat(texts), self.k)
        return [self._judged(*f) for f in found], [self._evidence(*f) for f in found] if evidence else []

    def _judged(self, ids: np.ndarray, near: np.ndarray) -> float:
        return 1 / (1 + math.exp(-(self.slope * self.odds(ids, near) + self.offset))) if len(ids) else self.rate

    def _evidence(self, ids: np.ndarray, near: np.ndarray) -> list[dict]:
        return [
            {"doc_id": self.example_id[i], "similarity": s, "label": int(self.label[i])}
            for i, s in zip(ids.tolist(), near.tolist(), strict=True)
        ]

    def calibrate(self, terms: np.ndarray, weights: np.ndarray, edges: np.ndarray) -> None:
        """Slope and offset of the log-odds by weighted logistic regression.

        On the examples, each of which the others judge; as a penalty, slope 1 and offset 0.
        """
        found = self.index.nearest_each(terms, weights, edges, self.k, np.arange(len(edges) - 1))
        x = np.array([self.odds(*f) for f in found])
        design, beta, prior = np.stack([x, np.ones(len(x))], axis=1), np.array([1.0, 0.0]), np.array([1.0, 0.0])
        weight = self.stands_for / self.stands_for.mean()
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
            gradient = design.T @ (weight * (self.label - p)) - (beta - prior)
            step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + np.eye(2), gradient)
            beta = beta + np.clip(step, -1, 1)
        self.slope, self.offset = float(max(beta[0], 0.05)), float(beta[1])


def _chunks(column: pa.Array) -> Iterator[list[bytes]]:
    held, size = [], 0
    for value in column.cast(pa.binary()):
        held.append(value.as_py() or b"")
        size += len(held[-1])
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _document_counts(batches: Iterator[pa.RecordBatch], terms: Broadcast) -> Iterator[pa.RecordBatch]:
    terms = terms.value
    seen = np.zeros(terms.size, np.int64)
    for batch in batches:
        for texts in _chunks(batch.column("text")):
            seen += np.bincount(terms.counts(texts)[0], minlength=terms.size)
    some = np.flatnonzero(seen)
    yield columns(term=pa.array(some), n=pa.array(seen[some]))


def _example_words(batch: pa.RecordBatch) -> pa.RecordBatch:
    words = [sorted(set((t or b"").lower().translate(BLANKS).split())) for t in batch.column("text").cast(pa.binary()).to_pylist()]
    return columns(
        doc_id=batch.column("doc_id"), label=batch.column("label"), text=batch.column("text"),
        words=pa.array(words, pa.list_(pa.binary())),
    )


def _scored(batch: pa.RecordBatch, model: Broadcast, text: str, evidence: bool) -> pa.RecordBatch:
    fitted, scores, found = model.value, [], []
    for texts in _chunks(batch.column("text") if "text" in batch.schema.names else batch.column("row").field(text)):
        some, because = fitted.scores(texts, evidence)
        scores += some
        found += because
    out = {n: batch.column(n) for n in batch.schema.names if n != "text"}
    out["score"] = pa.array(scores, pa.float64())
    if evidence:
        kind = pa.string() if any(isinstance(i, str) for i in fitted.example_id) else pa.int64()
        out["evidence"] = pa.array(found, pa.list_(pa.struct(
            [("doc_id", kind), ("similarity", pa.float64()), ("label", pa.int32())])))
    return columns(**out)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_examples: int = 4000,
    beginnings: int = 256,
    k: int = 15,
    seed: int = 5,
) -> Model:
    """Fit on labelled rows that are not held out.

    About ``max_examples`` rows at most are taken by a hash of the id, half of
    them of each label where there are enough; an example stands for as many
    rows as it was drawn from. Equal texts are one example. Terms are all words of
    the examples, and as many as ``beginnings`` beginnings of words, those of largest
    chi-square. A term's weight is its inverse document frequency over all documents, times
    ``PLAIN`` or, for a term of toxic examples, up to 1 by its chi-square: no word is left out.
    """
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(F.col(doc_id)) & F.col(doc_id).isNotNull())
    known = known.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = {y: min(1.0, max_examples / 2 / n) for y, n in sizes.items()}
    rate = sizes.get(1, 0) / max(1, sum(sizes.values()))
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 20))
    limit = F.lit(0)
    for y, part in share.items():
        limit = F.when(F.col("label") == y, int(part * (1 << 20))).otherwise(limit)
    # the join side has max_examples rows, which is what bounds it
    chosen = source.join(F.broadcast(known.where(drawn < limit)), "doc_id")
    ensure_checkpoint_dir(docs.sparkSession)
    examples = map_batches(
        chosen.groupBy(F.md5(F.coalesce("text", F.lit("")))).agg(
            F.min("doc_id").alias("doc_id"), F.max("label").alias("label"), F.first("text").alias("text")
        ).select("doc_id", "label", "text"),
        _example_words, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, label int, text string, words array<binary>",
    ).checkpoint()
    # the words of max_examples texts, as Arrow arrays
    in_order = examples.orderBy("doc_id", "text")
    rows = in_order.select("doc_id", "label", "words").toArrow().combine_chunks()
    ids, label = rows["doc_id"].to_pylist(), rows["label"].to_numpy().astype(np.int64)
    lists = rows["words"].combine_chunks()
    example = np.repeat(np.arange(len(rows)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    coded = lists.flatten().dictionary_encode()
    words, place = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    del rows, lists, coded
    order = sorted(range(len(words)), key=words.__getitem__)
    words, rank = [words[i] for i in order], np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    term = rank[place]
    start_names, starts = _beginnings(words)
    pairs = starts[term]
    known = pairs >= 0
    pairs = np.unique(np.repeat(example, pairs.shape[1]).reshape(pairs.shape)[known] * (len(start_names) + 1) + pairs[known])
    pairs = np.stack([pairs // (len(start_names) + 1), pairs % (len(start_names) + 1)], axis=1)
    of_words = telling(term, label[example], len(words), label)
    of_starts = telling(pairs[:, 1], label[pairs[:, 0]], len(start_names), label)
    least = max(3, 0.01 * label.sum())
    a = np.bincount(pairs[:, 1], label[pairs[:, 0]], minlength=len(start_names))
    strong = np.flatnonzero((of_starts >= TELLING) & (a >= least))
    strong = sorted(strong, key=lambda i: (-of_starts[i], start_names[i]))[:beginnings]
    names = [start_names[i] for i in sorted(strong)]
    telltale = np.concatenate([of_words, of_starts[sorted(strong)]])

    model = Model(words, names, np.ones(len(telltale)), None, label, np.array([1 / share[y] for y in label]),
                  ids, rate, k)
    spark = docs.sparkSession
    importable(spark)
    counted = source.select("text").mapInArrow(
        lean(partial(_document_counts, terms=spark.sparkContext.broadcast(model.terms))), "term long, n long"
    ).groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(telltale))
    df[counted["term"].to_numpy()] = counted["n"].to_numpy()
    idf = np.log((1 + docs.count()) / (1 + df)) + 1
    model.weight = idf * (PLAIN + (1 - PLAIN) * np.minimum(1, telltale / TELLING))
    del example, place, rank, term, pairs, known, starts, start_names, counted
    free(spark)  # before the texts come
    # like vectors into the same blocks: by label, then by their most common word, which tells languages apart
    texts = in_order.select("text").toArrow()["text"]
    parts = [model.flat(some) for chunk in texts.chunks for some in _chunks(chunk)]
    del texts
    terms = np.concatenate([np.empty(0, np.int64), *(t for t, _, _ in parts)])
    weights = np.concatenate([np.empty(0), *(w for _, w, _ in parts)])
    lengths = np.concatenate([np.empty(0, np.int64), *(np.diff(e) for _, _, e in parts)])
    del parts
    owner = np.repeat(np.arange(len(ids)), lengths)
    light = np.lexsort((terms, model.weight[terms], owner))
    lightest = np.full(len(ids), -1)
    lightest[lengths > 0] = terms[light[np.flatnonzero(np.diff(owner, prepend=-1))]]
    order = np.lexsort((np.arange(len(ids)), lightest, label))
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    moved = np.argsort(place[owner], kind="stable")
    terms, weights, edges = terms[moved], weights[moved], np.append(0, np.cumsum(lengths[order]))
    del owner, light, moved
    model.label, model.stands_for = label[order], model.stands_for[order]
    model.example_id = [model.example_id[i] for i in order]
    model.index = BlockMaxIndex.of(np.repeat(np.arange(len(ids)), lengths[order]), terms, weights, len(ids), len(telltale))
    if 0 < rate < 1:
        model.calibrate(terms, weights, edges)
    return model


def _beginnings(words: list[bytes]) -> tuple[list[str], np.ndarray]:
    """Beginnings of words, and for each word the numbers of its own, or -1."""
    number: dict[str, int] = {}
    found = np.full((len(words), len(BEGINNINGS)), -1)
    for i, word in enumerate(words):
        text = word.decode("utf-8", "surrogatepass")
        for j, n in enumerate(BEGINNINGS):
            if len(text) > n:
                found[i, j] = number.setdefault(text[:n], len(number))
    return list(number), found


def telling(term: np.ndarray, toxic: np.ndarray, terms: int, label: np.ndarray) -> np.ndarray:
    """Chi-square of each term where it is e times as frequent in toxic examples, else 0."""
    n, n1 = len(label), int(label.sum())
    n0 = n - n1
    a, both = np.bincount(term, toxic, minlength=terms), np.bincount(term, minlength=terms)
    b = both - a
    if not n0 or not n1:
        return np.zeros(terms)
    odds = np.log((a + 0.5) / (n1 + 1)) - np.log((b + 0.5) / (n0 + 1))
    chi = n * (a * n0 - b * n1) ** 2 / (float(n1) * n0 * both * (n - both + 1))
    return np.where(odds >= 1, chi, 0.0)


def scored(
    docs: DataFrame,
    model: Model,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    carry: list[str] | None = None,
    evidence: bool = False,
) -> DataFrame:
    """The columns ``carry`` (the id by default) as struct ``row``, ``held_out, score, predicted``.

    One row per input row; ``predicted`` is 1 from ``threshold`` on; ``evidence``
    adds the nearest examples with their similarity and label, equally near ones in the order of
    the index. A text without a word of any example, empty and null texts among them, gets
    the rate of toxic labels; without labels of both kinds every score is the
    rate of the label there is, or 0. Very long texts are scored whole. Null ids and repeated rows are documents
    like others; other columns are not looked at; an empty table gives no rows.
    """
    carry = [doc_id] if carry is None else carry
    source = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in carry)).alias("row"),
        held_out(F.col(doc_id)).alias("held_out"),
        *([] if text in carry else [F.col(text).alias("text")]),  # else it travels once, in the row
    )
    kind = source.schema["row"].dataType.simpleString()
    example = "string" if any(isinstance(i, str) for i in model.example_id) else "long"
    extra = f", evidence array<struct<doc_id:{example},similarity:double,label:int>>" if evidence else ""
    return map_batches(
        source, partial(
            _scored, model=docs.sparkSession.sparkContext.broadcast(model.to_send()), text=text, evidence=evidence
        ),
        f"row {kind}, held_out boolean, score double{extra}",
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic; all columns."""
    model = fit(docs, labels, **options)
    return scored(docs, model, carry=[*docs.columns]).where("predicted = 0").select("row.*")


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return scored(docs, fit(docs, labels)).select("row.doc_id", "held_out", "score", "predicted")
