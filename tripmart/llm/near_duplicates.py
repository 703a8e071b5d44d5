"""Near-duplicate classes by weighted MinHash.

Texts are bags of five-word shingles weighted by TF-IDF. Consistent weighted
sampling draws signature values that two texts share with the probability of
their weighted Jaccard similarity; bands of two values bring like texts into
buckets. A text with repeated shingles has a second signature, of its shingle set,
because sets may be alike where bags are not. Buckets are folded into families by comparing signatures with a few
pivots, and within a family every pair that can reach the threshold is verified
on the texts themselves. Components of the verified links are the classes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm import hashing
from tripmart.llm.components import components
from tripmart.llm.workers import columns, free, importable, lean, map_batches, slices
from tripmart.storage import ensure_checkpoint_dir

SHINGLE = 5
THRESHOLD = 0.8
VALUES = 20
BAND = 2
IDF_CELLS = 1 << 16
IDF_DAMPING = 0.25
#: Signature values that a text must share with a bucket's pivot to join its family.
#: A text at the threshold to the pivot has 16 of 20; fewer than 5 come up once in 10^8.
FAMILY_VALUES = 5
#: Texts compared at once; larger buckets and families are dealt out in blocks.
BLOCK = 800
#: Members of families, of some 150 bytes each, that are sent to the texts instead of meeting them.
SENT = 100_000
#: Bytes of text shingled and signed at once: what fits into a cache.
CHUNK = 200_000


def shingle_bags(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, how often each occurs, and where each text's begin.

    A text of one to four words is one shingle, an empty one has none.
    """
    words, starts = hashing.hashed_words(texts)
    n = np.diff(starts)
    edges = np.concatenate([[0], np.cumsum(np.maximum(n - SHINGLE + 1, n > 0))])
    flat = np.empty(edges[-1], np.uint64)
    owner = np.repeat(np.arange(len(texts)), n)
    windows = hashing.window_hashes(words, SHINGLE)
    at = np.flatnonzero(owner[: len(windows)] == owner[SHINGLE - 1 :])
    flat[edges[owner[at]] + at - starts[owner[at]]] = windows[at]
    for i in np.flatnonzero((n > 0) & (n < SHINGLE)):
        flat[edges[i]] = hashing.window_hashes(words[starts[i] : starts[i + 1]], int(n[i]))[0]
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if high - low > 1:
            flat[low:high].sort()
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[edges[:-1][np.diff(edges) > 0]] = True
    first = np.flatnonzero(new)
    return flat[first], np.diff(np.append(first, len(flat))), np.searchsorted(first, edges)


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The bag of one text."""
    return shingle_bags([(text or "").encode("utf-8", "surrogatepass")])[:2]


def _chunks(column: pa.Array) -> Iterator[list[bytes]]:
    """The texts of a column in runs of about ``CHUNK`` bytes, null as the empty text."""
    held, size = [], 0
    for value in column.cast(pa.binary()):
        held.append(value.as_py() or b"")
        size += len(held[-1])
        if size >= CHUNK:
            yield held
            held, size = [], 0
    if held:
        yield held


def _cells(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(48)).astype(np.int64) & (IDF_CELLS - 1)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(IDF_CELLS, np.int64)
    for batch in batches:
        for texts in _chunks(batch.column("text")):
            counts += np.bincount(_cells(shingle_bags(texts)[0]), minlength=IDF_CELLS)
    cells = np.flatnonzero(counts)
    yield columns(cell=pa.array(cells), n=pa.array(counts[cells]))


def idf_table(docs: DataFrame) -> np.ndarray:
    """Weight per cell of shingle hashes, from document frequencies over all documents.

    ``1 + damping * ln((1 + N) / (1 + df)) / ln(1 + N)``, df the documents'
    shingles in the cell. A cell is shared by the shingles that hash to it, so
    the table has a fixed size at any scale. The damping keeps the weight of a
    shingle that many copies share within a quarter of that of a rare one: a
    text stays near its copies however many there are.
    """
    importable(docs.sparkSession)
    counted = docs.select("text").mapInArrow(lean(_frequencies), "cell long, n long")
    rows = counted.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # one row a cell
    df = np.zeros(IDF_CELLS)
    df[rows["cell"].to_numpy()] = rows["n"].to_numpy()
    n = max(docs.count(), 1)
    return (1 + IDF_DAMPING * np.clip(np.log((1 + n) / (1 + df)), 0, None) / np.log(1 + n)).astype(np.float32)


@lru_cache(maxsize=1)
def _gamma() -> np.ndarray:
    """Quantiles of the Gamma(2, 1) distribution at 2^16 even steps."""
    x = np.concatenate([np.linspace(0, 1, 200_001)[1:] ** 2, np.linspace(1, 40, 400_001)[1:]])
    cdf = 1 - (1 + x) * np.exp(-x)
    return np.interp((np.arange(65_536) + 0.5) / 65_536, cdf, x).astype(np.float32)


@lru_cache(maxsize=1)
def _pairs() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r, ln c and ln c - r of 2^16 pairs of independent Gamma(2, 1) draws."""
    gamma = _gamma()
    ln_c = np.log(gamma[np.random.default_rng(17).permutation(1 << 16)])
    return gamma, ln_c, ln_c - gamma


#: For each value the odd number that turns a shingle's hash into its draws.
SEEDS = hashing.mixed(np.arange(1, VALUES + 1, dtype=np.uint64) * np.uint64(hashing.GOLDEN)) | np.uint64(1)
#: The least a of a text is exponential with its weight W: above ``SURE`` / W once in 22,000.
SURE = 10.0


def signatures(found: np.ndarray, edges: np.ndarray, weights: np.ndarray, sure: float = SURE) -> np.ndarray:
    """Improved consistent weighted sampling: a row of ``VALUES`` numbers for each text.

    ``found`` are the texts' shingles, text i's from ``edges[i]`` on. For each
    value every shingle draws r, c ~ Gamma(2, 1) and b ~ U(0, 1) from its hash,
    t = floor(ln w / r + b), ln a = ln c - r (t - b + 1); the value is that of the
    shingle and t with the least a. As ln a is ln c - r - ln w at least, only
    shingles where that is below ``sure`` over the text's weight are drawn in full; a
    text whose least a is not below it is drawn again without that bound. Texts
    without shingles have zeros.
    """
    n = len(edges) - 1
    value = np.zeros((VALUES, n), np.uint64)
    if not len(found):
        return value.T
    owner = np.repeat(np.arange(n), np.diff(edges))
    all_r, all_ln_c, least_ln_a = _pairs()
    total = np.bincount(owner, weights, minlength=n)
    bound = np.log(np.divide(sure, total, out=np.ones(n), where=total > 0)).astype(np.float32)
    ln_w = np.log(weights, dtype=np.float32)
    cut = bound[owner] + ln_w
    places, states, rest = [], [], []
    for k in range(VALUES):
        z = found * SEEDS[k]
        state = (z >> np.uint64(48)).view(np.int64)
        at = np.flatnonzero(least_ln_a[state] <= cut)
        places.append(at)
        states.append(state[at])
        rest.append((z[at] >> np.uint64(16)).view(np.int64) & 0xFFFF)
    at, state = np.concatenate(places), np.concatenate(states)
    if len(at):
        b = np.concatenate(rest).astype(np.float32) * np.float32(2.0**-16)
        key = np.repeat(np.arange(VALUES) * n, [len(p) for p in places]) + owner[at]
        r = all_r[state]
        t = np.floor(ln_w[at] / r + b)
        ln_a = all_ln_c[state] - r * (t - b + 1)
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        run = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(key))))
        least = np.minimum.reduceat(ln_a, starts)
        best = np.flatnonzero(ln_a == least[run])
        best = best[np.flatnonzero(np.diff(run[best], prepend=-1))]  # of equal ones the least hash
        times = t[best].astype(np.int64).astype(np.uint64)
        drawn = hashing.mixed(found[at[best]] + times * np.uint64(hashing.GOLDEN))
        here = least <= bound[key[starts] % n]
        value.reshape(-1)[key[starts][here]] = drawn[here]
    if sure < np.inf:
        for i in np.flatnonzero((value == 0).any(axis=0) & (total > 0)):
            own = slice(edges[i], edges[i + 1])
            value[:, i] = signatures(found[own], np.array([0, own.stop - own.start]), weights[own], np.inf)[0]
    return value.T.copy()


def signature(found: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The signature of one text."""
    return signatures(found, np.array([0, len(found)]), weights)[0]


def _signed(batch: pa.RecordBatch, idf: np.ndarray) -> pa.RecordBatch:
    """Signature of the bag, and behind it that of the set if a shingle repeats.

    Of a text without repeats the one signature is both. Set weights lie within 1
    and 1 + damping, so sets of plain similarity 0.8 have a weighted one of
    0.8 / (0.8 + 0.2 * 1.25) = 0.76 at least. Equal texts of a batch are signed once.
    """
    digests = batch.column("digest").to_pylist()
    place = {d: i for i, d in reversed(list(enumerate(digests)))}
    once = sorted(place.values())
    number = {i: k for k, i in enumerate(once)}
    drawn: list[np.ndarray] = []
    for texts in _chunks(batch.column("text").take(pa.array(once, pa.int64()))):
        found, times, edges = shingle_bags(texts)
        weights = idf[_cells(found)]
        owner = np.repeat(np.arange(len(texts)), np.diff(edges))
        again = np.bincount(owner, times > 1, minlength=len(texts)) > 0
        bags = signatures(found, edges, weights * times.astype(np.float32))
        own, two = again[owner], np.flatnonzero(again)
        sets = signatures(found[own], np.append(0, np.cumsum(np.diff(edges)[two])), weights[own])
        place_of = dict(zip(two.tolist(), sets, strict=True))
        drawn += [np.concatenate([b, place_of[i]]) if i in place_of else b for i, b in enumerate(bags)]
    mine = [drawn[number[place[d]]].view(np.int64) for d in digests]
    offsets = np.cumsum([0, *map(len, mine)], dtype=np.int32)
    flat = np.concatenate(mine) if mine else np.empty(0, np.int64)
    return columns(
        doc_id=batch.column("doc_id"), digest=batch.column("digest"),
        sig=pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
    )


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, list]]:
    """Runs of rows with equal keys out of a partition sorted by them."""
    held: dict[str, list] = {}
    current = None
    for batch in slices(batches):
        rows = batch.to_pydict()
        marks = list(zip(*(rows[k] for k in keys), strict=True))
        start = 0
        for i in range(1, len(marks) + 1):
            if i < len(marks) and marks[i] == marks[start]:
                continue
            part = {c: v[start:i] for c, v in rows.items()}
            if marks[start] == current:
                for c, v in part.items():
                    held[c] += v
            else:
                if current is not None:
                    yield held
                held, current = part, marks[start]
            start = i
    if current is not None:
        yield held


def _canopies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a bucket's texts to pivots: the first text left over is the next pivot."""
    for group in _groups(batches, ["bucket", "part"]):
        digests = np.array(group["digest"], object)
        bags = np.array([s[:VALUES] for s in group["sig"]], np.int64)
        sets = np.array([s[-VALUES:] for s in group["sig"]], np.int64)
        left = np.arange(len(digests))
        a, b = [], []
        while len(left):
            near = (bags[left] == bags[left[0]]).sum(axis=1) >= FAMILY_VALUES
            near |= (sets[left] == sets[left[0]]).sum(axis=1) >= FAMILY_VALUES
            near[0] = True
            a += [digests[left[0]]] * int(near.sum())
            b += list(digests[left[near]])
            left = left[~near]
        yield columns(
            bucket=pa.array(group["bucket"][:1] * len(a), pa.int64()),
            a=pa.array(a, pa.string()), b=pa.array(b, pa.string()),
        )


def _families(texts: DataFrame) -> DataFrame:
    """``digest, label``: blocks of texts of texts that share buckets and are like their pivots there."""
    bag, shingle_set = (
        F.array(*(
            F.xxhash64(F.lit(i), *(F.get("sig", F.lit(low + i * BAND + j)) for j in range(BAND)))
            for i in range(VALUES // BAND)
        ))
        for low in (0, VALUES)
    )
    # both kinds share the buckets: the signature of a text without repeats is of either kind
    bands = F.when(F.size("sig") > VALUES, F.array_union(bag, shingle_set)).otherwise(F.array_distinct(bag))
    keys = texts.select("digest", F.explode(bands).alias("bucket"))
    crowded = keys.groupBy("bucket").count().where("count > 1")
    members = keys.join(crowded, "bucket")
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def compared(dealt: DataFrame) -> DataFrame:
        """Links within the parts of buckets."""
        return (
            dealt.join(texts.select("digest", "sig"), "digest").select("bucket", "part", "digest", "sig")
            .repartition(n, "bucket", "part").sortWithinPartitions("bucket", "part", "digest")
            .mapInArrow(lean(_canopies), "bucket long, a string, b string").checkpoint()
        )

    parts = F.ceil(F.col("count") / BLOCK).cast("int")
    links, round_number, crowds = [], 0, True
    while crowds:
        part = F.pmod(F.xxhash64("digest", F.lit(round_number)), parts).cast("long")
        found = compared(members.withColumn("part", part))
        links.append(found.select("a", "b"))
        # of a bucket in several parts, the pivots meet again, dealt in another way
        again = members.where(F.col("count") > BLOCK).select("bucket", F.col("count").alias("were")).distinct()
        pivots = found.select("bucket", F.col("a").alias("digest")).distinct().join(again, "bucket")
        sizes = pivots.groupBy("bucket").count().where("count > 1")
        pivots = pivots.join(sizes, "bucket").withColumn("stuck", F.col("count") * 4 > F.col("were") * 3).checkpoint()
        crowds, stuck = pivots.agg(F.count_if(~F.col("stuck")), F.count_if("stuck")).first()
        if stuck:  # where they hardly get fewer, every part meets every other one
            mine = F.pmod(F.xxhash64("digest", F.lit(-1)), parts).cast("long")
            pairs = F.transform(
                F.filter(F.sequence(F.lit(0), parts - 1), lambda k: (k != mine) | (parts == 1)),
                lambda k: F.least(k, mine) * parts + F.greatest(k, mine),
            )
            links.append(compared(pivots.where("stuck").withColumn("part", F.explode(pairs))).select("a", "b"))
        members = pivots.where("NOT stuck").select("bucket", "digest", "count")
        round_number += 1
        free(texts.sparkSession)
    whole = links[0]
    for more in links[1:]:
        whole = whole.unionAll(more)
    return components(whole)


class _Union:
    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i


def linked(texts: list[str], sides: list[int], across: bool, idf: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what pairs of similarity ``THRESHOLD`` or more join, no pair twice.

    ``across``: only pairs with a text of side 0. A pair that reaches the
    threshold, weighted or plain, shares a shingle among the rarest of either text
    that make up more than the rest of its weight or of its number of shingles;
    only such pairs are compared, and of those no pair that links already join.
    """
    flat, often, edges = shingle_bags([(t or "").encode("utf-8", "surrogatepass") for t in texts])
    owner = np.repeat(np.arange(len(texts)), np.diff(edges))
    weights = often * idf[_cells(flat)].astype(np.float64)
    totals = np.bincount(owner, weights, minlength=len(texts))
    _, token, times = np.unique(flat, return_inverse=True, return_counts=True)
    order = np.lexsort((token, times[token], owner))
    token, owner, weights, times = token[order], owner[order], weights[order], times[token[order]]
    starts = np.searchsorted(owner, np.arange(len(texts) + 1))
    union, postings, links = _Union(len(texts)), {}, []
    full = np.zeros(len(times) and int(token.max()) + 1)
    for d in np.argsort(totals, kind="stable"):
        low, high = starts[d], starts[d + 1]
        if low == high:
            continue
        mine, w = token[low:high], weights[low:high]
        spent = np.cumsum(w)
        prefix = 1 + max(
            int(np.searchsorted(spent, (1 - THRESHOLD) * totals[d] + 1e-6)),
            int((1 - THRESHOLD) * (high - low) + 1e-6),
        )
        shared = [int(t) for t in mine[:prefix][times[low : low + prefix] > 1]]
        seen: set[int] = set()
        for t in shared:
            seen.update(postings.get(t, ()))
        if seen:
            full[mine] = w
            for c in sorted(seen):
                if across and sides[c] and sides[d]:
                    continue
                few, many = sorted((starts[c + 1] - starts[c], high - low))
                if totals[c] < THRESHOLD * totals[d] - 1e-6 and few < THRESHOLD * many - 1e-6:
                    continue
                if union.root(c) == union.root(d):
                    continue
                theirs = slice(starts[c], starts[c + 1])
                there = full[token[theirs]]
                common = np.minimum(there, weights[theirs]).sum()
                both = np.count_nonzero(there)
                if common >= THRESHOLD * (totals[c] + totals[d] - common) - 1e-9 or (
                    both >= THRESHOLD * (starts[c + 1] - starts[c] + high - low - both) - 1e-9
                ):
                    union.parent[union.root(c)] = union.root(d)
                    links.append((int(c), int(d)))
            full[mine] = 0
        for t in shared:
            postings.setdefault(t, []).append(int(d))
    return links


def _verified(batches: Iterator[pa.RecordBatch], idf: np.ndarray, across: bool) -> Iterator[pa.RecordBatch]:
    """Links ``a, b`` within groups, and a row without ``b`` for each text they leave apart from the pivot."""
    for group in _groups(batches, ["label", "i", "j"]):
        once: dict[str, int] = {}  # repeated rows are one text, on side 0 if it is on both
        for k, d in enumerate(group["digest"]):
            if d not in once or group["side"][k] < group["side"][once[d]]:
                once[d] = k
        keep = sorted(once.values())
        digests = [group["digest"][k] for k in keep]
        found = linked([group["text"][k] for k in keep], [group["side"][k] for k in keep], across, idf)
        apart = []
        if not across and group["label"][0] in once:
            union = _Union(len(keep))
            for c, d in found:
                union.parent[union.root(c)] = union.root(d)
            pivot = union.root(digests.index(group["label"][0]))
            apart = [d for k, d in enumerate(digests) if union.root(k) != pivot]
        yield columns(
            a=pa.array([digests[c] for c, _ in found] + apart, pa.string()),
            b=pa.array([digests[d] for _, d in found] + [None] * len(apart), pa.string()),
        )


def _links(source: DataFrame, families: DataFrame, texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """Verified links ``a, b`` that join what alike texts of a family join.

    A family over ``BLOCK`` texts is dealt into parts, and the text it is named by, its
    pivot, is in each. Texts that this leaves apart from the pivot, then, meet all
    parts. So a family of near copies of one text is sent once, whatever its size.
    """
    spark = source.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = families.groupBy("label").count()
    parts = F.ceil(F.col("count") / BLOCK).cast("int")
    members = families.join(sizes, "label").select(
        F.col("node").alias("digest"), "label", parts.alias("parts"),
        F.pmod(F.xxhash64("node", F.lit(11)), parts).cast("int").alias("part"),
    ).join(texts.select("digest", "rep"), "digest").checkpoint()

    def compared(rows: DataFrame, across: bool) -> DataFrame:
        """``rows``: members with ``places``, an array of (i, j, side)."""
        own = (source["digest"] == rows["digest"]) & source["doc_id"].eqNullSafe(rows["rep"])
        # of few members, their ids go to the texts; else texts and members meet by digest
        sent = F.broadcast(rows) if rows.count() <= SENT else rows
        return (
            source.join(sent, own).select(source["digest"], "text", "label", F.explode("places").alias("to"))
            .select("label", "to.i", "to.j", "to.side", "digest", "text")
            .repartition(n, "label", "i", "j").sortWithinPartitions("label", "i", "j", "digest")
            .mapInArrow(lean(partial(_verified, idf=idf, across=across)), "a string, b string").checkpoint()
        )

    def place(i, j, side: int):
        return F.struct(i.alias("i"), j.alias("j"), F.lit(side).alias("side"))

    zero = F.lit(0)
    pivot = F.transform(F.sequence(zero, F.col("parts") - 1), lambda k: place(zero, k, 0))
    found = compared(members.withColumn(
        "places", F.when(F.col("digest") == F.col("label"), pivot).otherwise(F.array(place(zero, F.col("part"), 0)))
    ), across=False)
    links = found.where("b IS NOT NULL")
    known = members.where("parts > 1").join(
        found.where("b IS NULL").select(F.col("a").alias("digest"), F.lit(True).alias("apart")), "digest", "left"
    ).withColumn("apart", F.coalesce("apart", F.lit(False)))
    left = known.where("apart")
    free(spark)
    counts = left.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("left_parts")).checkpoint()
    if not counts.count():
        return links
    block = F.pmod(F.xxhash64("digest", F.lit(13)), F.col("left_parts")).cast("int")
    all_parts = F.transform(F.sequence(zero, F.col("parts") - 1), lambda k: place(block, k, 0))
    rest = F.transform(F.sequence(zero, F.col("left_parts") - 1), lambda k: place(k, F.col("part"), 1))
    rows = known.join(counts, "label").withColumn(
        "places", F.when(F.col("apart"), F.concat(all_parts, rest)).otherwise(rest)
    )
    return links.unionAll(compared(rows.select("digest", "rep", "label", "places"), across=True))


def _digest(text: str):
    return F.md5(F.coalesce(F.col(text), F.lit("")))


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, digest, class, class_id, n_copies, n_texts`` for every row.

    ``class`` is a digest that names the class, ``class_id`` is the least doc_id of the class, ``n_copies`` the rows with the
    same text, ``n_texts`` the different texts of the class. Two texts are linked
    from a weighted Jaccard similarity of their bags of 0.8 on, or a plain one of
    their shingle sets, however often a shingle repeats; classes are the components,
    and equal texts are one class. Null and empty texts are copies of each other;
    texts of one to four words are one shingle; null ids come after others and a
    class with none else has a null ``class_id``; repeated rows are copies; other
    columns are not looked at; an empty table gives no rows.

    Whole texts, very long ones too, are shingled twice, for frequencies and for
    signatures. Texts of families are shuffled once, and before, if members are more than
    ``SENT``, all texts to meet them; of a family over 800 texts, those that are not like its pivot, in several
    steps, are sent as often as it has parts.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    source = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), _digest(text).alias("digest")
    )
    kind = source.schema["doc_id"].dataType.simpleString()
    idf = idf_table(source)
    signed = map_batches(
        source, partial(_signed, idf=idf), f"doc_id {kind}, digest string, sig array<long>"
    ).checkpoint()
    texts = signed.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("n_copies"), F.first("sig").alias("sig")
    )
    free(spark)
    families = _families(texts).checkpoint()
    free(spark)
    found = _links(source, families, texts, idf)
    free(spark)
    classes = components(found).withColumnsRenamed({"node": "digest", "label": "class"})
    placed = texts.drop("sig").join(classes, "digest", "left").select(
        "digest", "rep", "n_copies", F.coalesce("class", "digest").alias("class")
    )
    heads = placed.groupBy("class").agg(F.min("rep").alias("class_id"), F.count("*").alias("n_texts"))
    verdicts = placed.join(heads, "class").select("digest", "class", "class_id", "n_copies", "n_texts")
    return signed.select("doc_id", "digest").join(verdicts, "digest").select(
        "doc_id", "digest", "class", "class_id", "n_copies", "n_texts"
    )


def deduplicated(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class of near duplicates, the one with the least doc_id; all columns."""
    first = (
        near_duplicates(docs, doc_id=doc_id, text=text)
        .groupBy("class").agg(F.min_by("digest", F.struct(F.col("doc_id").isNull(), "doc_id")).alias("digest"))
        .select("digest")
    )
    rows = docs.select(
        _digest(text).alias("digest"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    )
    by_id = F.struct(F.col(f"row.`{doc_id}`").isNull(), F.col(f"row.`{doc_id}`"))
    return (
        rows.groupBy("digest").agg(F.min_by("row", by_id).alias("row"))
        .join(first, "digest", "left_semi").select("row.*")
    )


def op10_near_duplicates(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", "class_id", "n_copies", "n_texts")
