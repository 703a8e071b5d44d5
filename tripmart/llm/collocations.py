"""Phrases whose words stand together, mined with stripes.

A stripe is a prefix of up to three words with a counter of the words that follow
it. Tasks count stripes of what they read, stripes of one prefix meet in one
task and are merged element by element. A merged stripe gives the counts of its
extensions, and what it holds in all is the count of its prefix; the empty prefix
counts the words. Levels run one after another: two words are counted where both
are frequent, three and four where all neighbours are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmart.llm import hashing
from tripmart.llm.workers import columns, importable
from tripmart.storage import ensure_checkpoint_dir

LEAST = 30
LONGEST = 4
TOP = 2000
SUBSUMED = 80
#: Ends a piece; no byte of UTF-8 text.
END = b"\xff"
BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", END * 10 + b" ")
#: Bytes of text counted at once, different words and stripe entries held before they are sent.
CHUNK = 8 << 20
HELD_WORDS = 300_000
HELD_ENTRIES = 2_000_000
#: Bits of the filters that later levels ask; fewer are used for few phrases.
LEAST_BITS, MOST_BITS = 16, 27
#: A prefix is hot if it has more than one in this many words per partition.
HOT = 8
#: Parts of a language that are ranked apart before they are ranked together.
RANK_PARTS = 16


def fold(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a word sequence from that of the words before and that of the last one."""
    return hashing.mixed(before * np.uint64(hashing.GOLDEN | 1) + word)


class _Words(dict):
    """Numbers of words in order of appearance, with their hashes; 0 ends a piece."""

    def __init__(self) -> None:
        super().__init__({END: 0})
        self.hashes = [0]

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        self.hashes.append(xxhash.xxh3_64_intdigest(word))
        return found


@dataclass(frozen=True)
class Level:
    """What to count: phrases of these sizes whose neighbours are in ``frequent``.

    ``frequent`` has bits of hashes of words (for size 2) or of pairs of words;
    it may let other phrases through, which are then counted, too. ``hot`` are
    hashes of prefixes whose stripes are dealt out by their next words.
    """

    sizes: tuple[int, ...]
    frequent: np.ndarray | None
    hot: np.ndarray
    shards: int

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(len(self.frequent) * 8 - 1)
        return (self.frequent[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _runs(high: np.ndarray, low: np.ndarray | None, counts: np.ndarray | None):
    """Different keys (``high``, ``low``) and the sum of their counts."""
    if low is None and counts is None:
        high, counts = np.unique(high, return_counts=True)
        return high, None, counts
    order = np.argsort(high, kind="stable") if low is None else np.lexsort((low, high))
    high, low = high[order], None if low is None else low[order]
    new = np.ones(len(high), bool)
    new[1:] = high[1:] != high[:-1]
    if low is not None:
        new[1:] |= low[1:] != low[:-1]
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(high))) if counts is None else np.add.reduceat(counts[order], at)
    return high[at], None if low is None else low[at], counts


class _Stripes:
    """Counters of one language's phrases."""

    def __init__(self, lang: str, level: Level) -> None:
        self.level, self.lang, self.words = level, lang, _Words()
        self.seed = np.array([xxhash.xxh3_64_intdigest(lang.encode())], np.uint64)
        self.held: dict[int, list[tuple]] = {size: [] for size in level.sizes}
        self.entries = 0

    def add(self, texts: list[bytes]) -> None:
        joined = (END.join(texts) + END).lower().translate(BREAKS).replace(END, b" " + END + b" ").split()
        ids = np.fromiter(map(self.words.__getitem__, joined), np.int64, len(joined))
        del joined
        hashes = np.array(self.words.hashes, np.uint64)
        if 2 in self.level.sizes:
            known = self.level.passes(fold(self.seed, hashes))
            known[0] = False
            near = known[ids[:-1]] & known[ids[1:]]
        elif self.level.frequent is not None:
            near = (ids[:-1] > 0) & (ids[1:] > 0)
            some = np.flatnonzero(near)
            near[some] = self.level.passes(fold(fold(self.seed, hashes[ids[some]]), hashes[ids[some + 1]]))
        for size in self.level.sizes:
            if size == 1:
                at = np.flatnonzero(ids)
            else:
                together = near[: len(near) - size + 2].copy()
                for j in range(1, size - 1):
                    together &= near[j : len(near) - size + 2 + j]
                at = np.flatnonzero(together)
            if not len(at):
                continue
            high = ids[at] << 32 | ids[at + 1] if size > 1 else ids[at]
            low = None
            if size > 2:
                low = ids[at + 2] << 32 | (ids[at + 3] if size > 3 else 0)
            found = _runs(high, low, None)
            self.held[size].append(found)
            self.entries += len(found[0])

    def entries_of(self, size: int) -> tuple | None:
        """Shards, ascending, numbers of stripes, word numbers and counts of the entries held."""
        if not self.held[size]:
            return None
        parts = self.held[size]
        low = np.concatenate([p[1] for p in parts]) if size > 2 else None
        high, low, counts = _runs(np.concatenate([p[0] for p in parts]), low, np.concatenate([p[2] for p in parts]))
        ids = [high] if size == 1 else [high >> 32, high & 0xFFFFFFFF]
        if size > 2:
            ids += [low >> 32] + [low & 0xFFFFFFFF] * (size > 3)
        hashes = np.array(self.words.hashes, np.uint64)
        prefix, split = np.repeat(self.seed, len(high)), np.zeros(len(high), bool)
        stripe = np.zeros(len(high), bool)
        for k, x in enumerate(ids[:-1]):
            prefix = fold(prefix, hashes[x])
            stripe[1:] |= x[1:] != x[:-1]
            if k < 2:
                split |= np.isin(prefix, self.level.hot)
        shard = np.where(split | (size == 1), fold(prefix, hashes[ids[-1]]), prefix) % np.uint64(self.level.shards)
        order = np.argsort(shard, kind="stable")
        return shard[order].astype(np.int64), np.cumsum(stripe)[order], [x[order] for x in ids], counts[order]


def _packed(stripes: dict[str, _Stripes]) -> Iterator[pa.RecordBatch]:
    """One row for each language, size and shard, with the stripes in it.

    ``prefixes`` and ``nexts`` are words, one a line, ``lengths`` the entries of each
    stripe, ``counts`` those of each entry; all compressed.
    """
    for lang, held in stripes.items():
        words = np.array(list(held.words), object)
        for size in held.level.sizes:
            if (found := held.entries_of(size)) is None:
                continue
            shard, stripe, ids, counts = found
            starts = np.flatnonzero(np.diff(shard * (int(stripe.max()) + 1) + stripe, prepend=-1))
            lengths = np.diff(np.append(starts, len(shard)))
            prefixes = [b" ".join(w) for w in zip(*(words[x[starts]] for x in ids[:-1]), strict=True)]
            prefixes = prefixes or [b""] * len(starts)
            edges = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
            runs = np.searchsorted(starts, edges)
            rows = [
                (int(shard[a]), prefixes[c:d], lengths[c:d], words[ids[-1][a:b]], counts[a:b])
                for a, b, c, d in zip(edges[:-1], edges[1:], runs[:-1], runs[1:], strict=True)
            ]
            yield columns(
                shard=pa.array([r[0] for r in rows], pa.int32()), lang=pa.array([lang] * len(rows)),
                prefixes=pa.array([zstandard.compress(b"\n".join(r[1]), 1) for r in rows]),
                lengths=pa.array([zstandard.compress(r[2].astype("<i4").tobytes(), 1) for r in rows]),
                nexts=pa.array([zstandard.compress(b"\n".join(r[3]), 1) for r in rows]),
                counts=pa.array([zstandard.compress(r[4].astype("<i8").tobytes(), 1) for r in rows]),
            )


def _unpacked(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    for lang, *cells in zip(*(batch.column(c).to_pylist() for c in ("lang", "prefixes", "lengths", "nexts", "counts")), strict=True):
        prefixes, lengths, nexts, counts = map(zstandard.decompress, cells)
        at = np.repeat(np.arange(len(lengths) // 4), np.frombuffer(lengths, "<i4"))
        yield pa.table({
            "lang": pa.array([lang]).take(pa.array(np.zeros(len(at), np.int64))),
            "prefix": pa.array(prefixes.split(b"\n"), pa.binary()).take(pa.array(at)),
            "next": pa.array(nexts.split(b"\n"), pa.binary()), "f": pa.array(np.frombuffer(counts, "<i8")),
        })


def _counted(batches: Iterator[pa.RecordBatch], level: Level) -> Iterator[pa.RecordBatch]:
    stripes: dict[str, _Stripes] = {}
    for batch in batches:
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}
        for lang, text in zip(batch.column("lang"), batch.column("text").cast(pa.binary()), strict=True):
            lang, text = lang.as_py(), text.as_py()
            waiting.setdefault(lang, []).append(text)
            sizes[lang] = sizes.get(lang, 0) + len(text)
            if sizes[lang] >= CHUNK:
                stripes.setdefault(lang, _Stripes(lang, level)).add(waiting.pop(lang))
                sizes[lang] = 0
        for lang, texts in waiting.items():
            stripes.setdefault(lang, _Stripes(lang, level)).add(texts)
        if (sum(s.entries for s in stripes.values()) > HELD_ENTRIES
                or sum(len(s.words) for s in stripes.values()) > HELD_WORDS):
            yield from _packed(stripes)
            stripes = {}
    yield from _packed(stripes)


def _merged(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Stripes of a partition, merged: extensions of ``least`` occurrences, and per language all words."""
    held, rows = [], 0
    def folded():
        return pa.concat_tables(held).group_by(["lang", "prefix", "next"]).aggregate([("f", "sum")]).rename_columns(
            ["lang", "prefix", "next", "f"])
    for batch in batches:
        for entries in _unpacked(batch):
            held.append(entries)
            rows += len(entries)
            if rows > 4 * HELD_ENTRIES:
                held = [folded()]
                rows = len(held[0]) // 2
    if not held:
        return
    whole = folded()
    words = whole.filter(pc.equal(whole["prefix"], b""))
    if len(words):
        totals = words.group_by("lang").aggregate([("f", "sum")])
        none = pa.nulls(len(totals), pa.string())
        yield columns(lang=totals["lang"].combine_chunks(), phrase=none, size=pa.array([0] * len(totals), pa.int32()),
                      f=totals["f_sum"].combine_chunks(), hash=pa.array([0] * len(totals), pa.int64()))
    whole = whole.filter(pc.greater_equal(whole["f"], least))
    rows = whole.to_pydict()
    phrases = [p + b" " + x if p else x for p, x in zip(rows["prefix"], rows["next"], strict=True)]
    words, of = [p.split(b" ") for p in phrases], xxhash.xxh3_64_intdigest
    sizes = np.array([len(w) for w in words], np.int32)
    hashes = np.array([of(x.encode()) for x in rows["lang"]], np.uint64)
    for k in range(sizes.max(initial=0)):
        at = np.flatnonzero(sizes > k)
        hashes[at] = fold(hashes[at], np.array([of(words[i][k]) for i in at], np.uint64))
    yield columns(
        lang=whole["lang"].combine_chunks(), phrase=pa.array(phrases, pa.binary()).cast(pa.string()),
        size=pa.array(sizes), f=whole["f"].combine_chunks(), hash=pa.array(hashes.view(np.int64)),
    )


def _stripes(docs: DataFrame, level: Level, least: int) -> DataFrame:
    dealt = docs.mapInArrow(partial(_counted, level=level), "shard int, lang string, prefixes binary, lengths binary, nexts binary, counts binary").repartition(
        level.shards, "shard"
    )
    return dealt.mapInArrow(
        partial(_merged, least=least), "lang string, phrase string, size int, f long, hash long"
    ).checkpoint()


def _filter(found: DataFrame) -> np.ndarray:
    """Bits of the hashes of ``found``: 32 for each up to a fixed number, so never more than 16 MB."""
    n = found.count()
    bits = min(MOST_BITS, max(LEAST_BITS, int(32 * max(n, 1)).bit_length()))
    cell = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    # 32 bits a row, at most 2^22 rows
    words = found.select(cell.alias("cell")).selectExpr(
        "shiftright(cell, 5) AS at", "shiftleft(1L, cast(cell % 32 AS int)) AS bit"
    ).groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 5), np.uint32)
    table[words["at"].to_numpy()] = words["bits"].to_numpy().astype(np.uint32)
    return table.view(np.uint8)


def _hot(found: DataFrame, words: int, shards: int) -> np.ndarray:
    """Hashes of the prefixes that have more than one word in ``HOT * shards``; at most so many."""
    rows = found.where(F.col("f") * (HOT * shards) > words).select("hash").toArrow()
    return rows["hash"].to_numpy().view(np.uint64)


def phrase_counts(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST) -> DataFrame:
    """``lang, phrase, size, f``: phrases of one to four words with ``least`` occurrences or more.

    Besides, a row of size 0 without phrase holds the number of all words of a
    language, possibly in several parts.
    """
    spark = docs.sparkSession
    importable(spark)
    ensure_checkpoint_dir(spark)
    source = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    none = np.empty(0, np.uint64)
    ones = _stripes(source, Level((1,), None, none, shards), least)
    words = ones.where("size = 0").agg(F.sum("f")).first()[0] or 0
    known = ones.where("size = 1")
    twos = _stripes(source, Level((2,), _filter(known), _hot(known, words, shards), shards), least)
    rest = _stripes(source, Level((3, 4), _filter(twos), _hot(twos, words, shards), shards), least)
    return ones.unionAll(twos).unionAll(rest).drop("hash")


def collocations(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST, subsumed: int = SUBSUMED,
    top: int | None = TOP,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of two to four words of each language.

    ASCII capitals are lowered; pieces end at ``. , ; : ! ?`` and line ends, words at
    blanks and tabs. ``a`` counts a phrase, ``l`` and ``r`` the parts of its cut of least
    ``score = floor(2000000 a / (l + r))`` (the first of equal ones), ``n`` all words. A
    phrase goes if one that is longer, whole and has ``subsumed`` percent of its
    occurrences holds its words in a row; of longer ones those with one word more
    suffice, since what lies between is as frequent. Ranks go by score, then count, then the phrase's bytes;
    ``top=None`` keeps all.

    Null texts are empty, a null language is ``und``, repeated rows count each time,
    other columns are not looked at, an empty table gives no rows. A very long text is
    counted whole, in memory some 20 times its size. Arithmetic is on decimals.
    """
    counts = phrase_counts(docs, text=text, lang=lang, least=least)
    f = counts.where("size > 0").select("lang", "phrase", "f")
    totals = counts.where("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    found = counts.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("w"))
    part = lambda low, n: F.array_join(F.slice("w", low, n), " ")
    cuts = found.select("lang", "phrase", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", part(1, F.col("k")).alias("left"),
        part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    scored = (
        cuts.join(f.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
        .join(f.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
        .withColumns({"two": F.lit(2_000_000).cast("decimal(7,0)") * wide("a"), "both": wide("l") + wide("r")})
        .withColumn("score", F.expr("two div both"))
        .groupBy("lang", "phrase").agg(
            F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
        )
    )
    around = found.where("size > 2").select("lang", "a", F.explode(F.array(
        part(1, F.col("size") - 1), part(2, F.col("size") - 1))).alias("phrase")
    ).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    best = scored.join(around, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * subsumed)
    ).select("lang", "phrase", "a", "cut.*")
    by = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    if top is not None:  # of each part of a language, so that few rows meet for its ranks
        some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).orderBy(*by)
        best = best.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by)).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    # languages are as many rows as totals; a sum each, joined last
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces
), counts AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
  FROM (
    SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i
    FROM words, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size
  ) GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang
), found AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= 30
), cuts AS (
  SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS lft, array_to_string(w[k + 1:size], ' ') AS rgt
  FROM (SELECT *, unnest(range(1, size)) AS k FROM found)
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r,
    ((2000000::HUGEINT * c.a) // (l.f::HUGEINT + r.f::HUGEINT))::BIGINT AS score
  FROM cuts c JOIN counts l ON l.lang = c.lang AND l.phrase = c.lft JOIN counts r ON r.lang = c.lang AND r.phrase = c.rgt
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT DISTINCT lang, array_to_string(w[i:i + n - 1], ' ') AS phrase, phrase AS longer, a
  FROM (SELECT *, unnest(range(1, size - n + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS n FROM found))
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM best b JOIN totals t ON t.lang = b.lang
WHERE NOT EXISTS (
  SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100::HUGEINT * i.a >= 80::HUGEINT * b.a)
QUALIFY rank <= 2000
"""
