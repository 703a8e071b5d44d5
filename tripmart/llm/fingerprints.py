"""Document fingerprints of spot signatures.

A spot signature is a common word and the content words that follow it: chains
that prose has everywhere, and furniture such as menus has not. The set of a
text's signatures is its fingerprint; two are as alike as the Jaccard similarity
of the sets, which a bound by their sizes and a walk over the sorted signatures
cut short where only similar ones are asked for.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm import hashing
from tripmart.llm.workers import columns, importable

# Common words of English, French, German and Spanish.
COMMON = """
a an and are as at be but by for from had has have he her his in is it not of on or that the their they this to was
were which will with you
au aux avec ce ces dans de des du elle en est et il la le les leur mais ne nous on ou par pas plus pour qui que sa se
ses son sont sur un une vous
als am auch auf aus bei das dass dem den der des die ein eine einen einer er es für hat im in ist mit nach nicht oder
sich sie sind so um und von war wie wird zu zum zur
al como con de del el ella en era es esta este fue ha hay la las lo los más no o para pero por que se si sin su sus
un una y
""".split()
#: Content words in a chain.
CHAIN = 2
#: Bytes of text that are signed at once.
CHUNK = 2 << 20
#: Range parts for each partition of the shuffle, so that their sizes even out.
PARTS = 8
TERM_BYTES = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
BLANKS = bytes(b if b in TERM_BYTES else 0x20 for b in range(256))
END = b"\xff"
HELD_WORDS = 200_000


class _Words(dict):
    """Numbers of words, 0 ends a text; with the hash of each and whether it is common."""

    def __init__(self, common: tuple[str, ...]) -> None:
        super().__init__()
        self.common = {w.encode() for w in common}
        self._begin()

    def _begin(self) -> None:
        self.clear()
        self[END] = 0
        self.hashes, self.anchors = [0], [True]

    def room(self) -> None:
        if len(self) > HELD_WORDS:
            self._begin()

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        self.anchors.append(word in self.common)
        return number


def _fold(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return hashing.mixed(before * np.uint64(hashing.GOLDEN | 1) + word)


def signature_sets(texts: list[str], words: _Words, chain: int = CHAIN) -> list[np.ndarray]:
    """The sorted signatures of each text.

    An anchor is a common word, and the start of a text is one. Its signature are
    the anchor and the next ``chain`` content words, fewer at the end of the text; one
    without a content word is none. A text of common words only has its words in
    their order as its only signature, one without words has no signature.
    """
    words.room()
    lowered = (t.encode("utf-8", "surrogatepass").lower().translate(BLANKS) for t in texts)
    found = (END + b" " + (b" " + END + b" ").join(lowered)).split()
    number = np.fromiter(map(words.__getitem__, found), np.int64, len(found))
    hashes, anchor = np.array(words.hashes, np.uint64), np.array(words.anchors)[number]
    starts = np.flatnonzero(number == 0)
    ends = np.append(starts[1:], len(number))
    content = np.flatnonzero(~anchor)
    at = np.flatnonzero(anchor)
    doc = np.searchsorted(starts, at, side="right") - 1
    first = np.searchsorted(content, at)
    padded = np.append(content, np.full(chain, len(number)))
    value = hashes[number[at]]
    inside = None
    for k in range(chain):
        follower = padded[first + k]
        here = follower < ends[doc]
        value = _fold(value, np.where(here, hashes[number[np.minimum(follower, len(number) - 1)]], np.uint64(0)))
        inside = here if inside is None else inside
    value, doc = value[inside], doc[inside]
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[new], doc[new]
    edges = np.searchsorted(doc, np.arange(len(texts) + 1))
    sets = [value[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    for i in np.flatnonzero(np.diff(edges) == 0):
        own = hashes[number[starts[i] + 1 : ends[i]]]
        if len(own):
            whole = np.zeros(1, np.uint64)
            for w in own:
                whole = _fold(whole, np.array([w]))
            sets[i] = whole
    return sets


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets; 0 if it is below ``least``, 1 for two empty ones.

    Sizes decide first, then the part of the sets walked so far: what is left can
    at best be common. With ``least`` 0 there is nothing to cut.
    """
    small, large = sorted((a, b), key=len)
    if not len(large):
        return 1.0
    if len(small) < least * len(large):
        return 0.0
    if least > 0:
        most = int((len(a) + len(b)) * (1 - least) / (1 + least) + 1e-9)  # elements of one set alone
        alone, step = 0, max(64, len(small) // 8)
        for low in range(0, len(small), step):
            part = small[low : low + step]
            alone += len(part) - int(np.isin(part, large, assume_unique=True).sum())
            if alone * 2 + len(large) - len(small) > most:
                return 0.0
        common = len(small) - alone
    else:
        common = len(a) + len(b) - len(np.union1d(a, b))
    similar = common / (len(a) + len(b) - common)
    return similar if similar >= least else 0.0


def digest(signatures: np.ndarray) -> str:
    """The fingerprint as text: the SHA-256 of the sorted signatures."""
    return hashlib.sha256(signatures.astype("<u8").tobytes()).hexdigest()


def _signed(batches: Iterator[pa.RecordBatch], common: tuple[str, ...], chain: int) -> Iterator[pa.RecordBatch]:
    words = _Words(common)
    for batch in batches:
        low, size, texts = 0, 0, []
        for i, value in enumerate(batch.column("text")):
            texts.append(value.as_py())
            size += len(texts[-1])
            if size >= CHUNK or i + 1 == len(batch):
                sets = signature_sets(texts, words, chain)
                offsets = np.cumsum([0, *map(len, sets)], dtype=np.int32)
                flat = np.concatenate(sets).view(np.int64)
                yield columns(
                    doc_id=batch.column("doc_id").slice(low, len(texts)),
                    fingerprint=pa.array([digest(s) for s in sets]),
                    signatures=pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                )
                low, size, texts = i + 1, 0, []


def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    importable(docs.sparkSession)
    return docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")
    )


def fingerprinted(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", common: tuple[str, ...] = tuple(COMMON), chain: int = CHAIN
) -> DataFrame:
    """``doc_id, fingerprint, signatures`` of every row; see ``signature_sets``."""
    source = _source(docs, doc_id, text)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        partial(_signed, common=common, chain=chain), f"doc_id {kind}, fingerprint string, signatures array<long>"
    )


def _place(bounds: list[int], key: str, tie: str) -> Column:
    """Number of the range part of a row; a value that fills several parts is dealt by ``tie``."""
    values = F.lit(bounds) if bounds else F.array().cast("array<long>")
    steps = F.lit([1 << k for k in reversed(range(max(1, len(bounds).bit_length())))])

    def search(below) -> Column:
        return F.aggregate(
            steps, F.lit(0),
            lambda low, step: F.when(below(F.get(values, low + step - 1)), low + step).otherwise(low),
        )

    low = search(lambda v: v < F.col(key))
    high = search(lambda v: v <= F.col(key))
    share = F.col(tie) / F.lit(2.0**64) + 0.5  # 0 to 1, in the order of ties
    return (low + F.floor((high - low) * share)).cast("int")


def followed(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows in descending order of ``doc_id`` as parts sorted within partitions.

    ``part, ahead, key, tie, doc_id, text``: every part ends with the row that follows
    its last one, marked ``ahead``. Parts are ranges of ids with about as many rows
    each; bounds and heads of parts are a few for every partition and all that the
    driver sees. Texts are shuffled once. Rows of one id are in the order of a hash of their texts.
    """
    source = _source(docs, doc_id, text)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = source.select(
        "doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"),
        F.xxhash64("text").alias("tie"),
    )
    parts = PARTS * n
    bounds = keyed.agg(F.percentile_approx(
        "key", [k / parts for k in range(1, parts)], max(10_000, 4 * parts)
    )).first()[0] or []
    placed = keyed.withColumn("part", _place(list(bounds), "key", "tie"))
    heads = [
        (r["part"], *r["head"]) for r in
        placed.groupBy("part").agg(F.max(F.struct("key", "tie")).alias("head")).orderBy("part").collect()
    ]
    # the head of a part also follows the part above it, and the first of all the last
    sent = [(part, key, tie, heads[(i + 1) % len(heads)][0]) for i, (part, key, tie) in enumerate(heads)]
    heads = docs.sparkSession.createDataFrame(sent, "part int, key long, tie long, above int")
    own = placed.join(F.broadcast(heads), ["part", "key", "tie"], "left")  # a row for each part
    both = own.select("key", "tie", "doc_id", "text", F.explode(F.filter(F.array(
        F.struct("part", F.lit(False).alias("ahead")), F.struct(F.col("above").alias("part"), F.lit(True).alias("ahead")),
    ), lambda x: x["part"].isNotNull())).alias("to"))
    return (
        both.select("to.part", "to.ahead", "key", "tie", "doc_id", "text").repartition(n, "part")
        .sortWithinPartitions("part", "ahead", F.desc("key"), F.desc("tie"))
    )


def _compared(batches: Iterator[pa.RecordBatch], common: tuple[str, ...], chain: int) -> Iterator[pa.RecordBatch]:
    words = _Words(common)

    def compared(ids: list, texts: list[str]) -> pa.RecordBatch:
        own, following = texts[:-1], texts[1:]
        edited = []
        for t, f in zip(own, following, strict=True):
            third = len(t) // 3
            edited.append(t[: len(t) - third] + f[:third])
        sets = signature_sets([*texts, *edited], words, chain)
        mine, theirs = sets[: len(own)], sets[1 : len(texts)]
        changed = sets[len(texts) :]
        return columns(
            doc_id=pa.array(ids, pa.int64()), n_chars=pa.array([len(t) for t in own], pa.int64()),
            edited_sha256=pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in edited]),
            fingerprint=pa.array([digest(s) for s in mine]), edited_fingerprint=pa.array([digest(s) for s in changed]),
            near_edited=pa.array([likeness(a, b) for a, b in zip(mine, changed, strict=True)], pa.float64()),
            near_next=pa.array([likeness(a, b) for a, b in zip(mine, theirs, strict=True)], pa.float64()),
        )

    ids, texts, size, current = [], [], 0, None
    for batch in batches:
        rows = (batch.column(c) for c in ("part", "ahead", "doc_id", "text"))
        for part, ahead, doc, text in zip(*rows, strict=True):
            part, ahead, text = part.as_py(), ahead.as_py(), text.as_py()
            if ahead and not texts:
                continue  # a part's end comes once for each equal row
            texts.append(text)
            if ahead:
                yield compared(ids, texts)
                ids, texts, size = [], [], 0
                continue
            if size >= CHUNK:
                yield compared(ids, texts)
                ids, texts, size = [], [text], 0
            ids.append(doc.as_py())
            size += len(text)


def compared(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", common: tuple[str, ...] = tuple(COMMON), chain: int = CHAIN
) -> DataFrame:
    """How stable the fingerprint of each document is, and how far it is from another one's.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``: the edited text has the last third of the code points replaced by the
    first as many (or all) of the next document in descending order of ``doc_id``; the
    first of all follows the last. Likenesses are exact.

    Null texts are empty, an empty text's fingerprint is that of the empty set, and two
    empty sets are alike by 1; null ids come last, rows of one id are ordered by a hash of
    their texts; equal rows are documents each; a single document follows itself; other
    columns are not looked at; an empty table gives no rows. A very long text is signed
    whole, in memory some 20 times its size.
    """
    rows = followed(docs, doc_id=doc_id, text=text)
    return rows.mapInArrow(
        partial(_compared, common=common, chain=chain),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )


def op13_fingerprints(spark, sf_dir: str) -> DataFrame:
    return compared(spark.read.parquet(f"{sf_dir}/documents.parquet"))
