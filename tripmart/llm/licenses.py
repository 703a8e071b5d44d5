"""Licence scan: an exact set-similarity join of text blocks with licence templates.

A block is a run of consecutive words of one document. It joins a template when
it holds at least ``containment`` of the template's distinct words. Templates'
words are ordered by their frequency in the whole corpus, rarest first. A block
that reaches the threshold must hold one of the first words in that order (prefix
filter); a place of such a word is only looked at if the rarer words that the
block lacks leave enough (positional filter), and documents with too few template
words are passed over (length filter).
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.workers import columns, map_batches, texts

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}

# Phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wording of licence notices and its labels; a label may have several.
TEMPLATES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "it under the terms of the gnu general public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
)


def words_of(text: str) -> list[str]:
    """Lower-cases A to Z only; words are ASCII letters, digits and all beyond ASCII."""
    return WORD.findall(text.translate(LOWER) if not text.isascii() else text.lower())


@dataclass(frozen=True)
class Template:
    """``words`` are distinct, rarest first; a block is ``span`` words, ``need`` must be in it."""

    label: str
    words: tuple[str, ...]
    span: int
    need: int

    @property
    def prefix(self) -> tuple[str, ...]:
        return self.words[: len(self.words) - self.need + 1]


def ordered(
    templates: tuple[tuple[str, str], ...], counts: dict[str, int], containment: float, slack: float
) -> list[Template]:
    found = []
    for label, text in templates:
        run = words_of(text)
        distinct = tuple(sorted(set(run), key=lambda w: (counts.get(w, 0), w)))
        need = math.ceil(containment * len(distinct) - 1e-9)
        found.append(Template(label, distinct, math.ceil(slack * len(run)), need))
    return found


def _counted(batch: pa.RecordBatch, vocabulary: frozenset[str]) -> pa.RecordBatch:
    seen: Counter[str] = Counter()
    for text in texts(batch.column("text")):
        seen.update(filter(vocabulary.__contains__, words_of(text)))
    return columns(word=pa.array(list(seen), pa.string()), n=pa.array(seen.values(), pa.int64()))


def phrase_places(words: list[str], places: dict[str, list[int]], phrase: str) -> list[int]:
    parts = phrase.split()
    rarest = min(range(len(parts)), key=lambda i: len(places.get(parts[i], ())))
    starts = (p - rarest for p in places.get(parts[rarest], ()))
    return [s for s in starts if s >= 0 and words[s : s + len(parts)] == parts]


def all_blocks(
    places: dict[str, list[int]], t: Template, skipped: list[int] | None = None
) -> list[tuple[int, int]]:
    """Distinct words of ``t`` and start of every block that reaches ``need``, by start.

    A block starts at a word of the template; one that starts elsewhere holds no
    more than the one that starts at its first such word. Blocks that overlap are
    all there. Every block is found at its rarest word, which is in the prefix: at each
    place of such a word, the words after it in the order that stand near are counted, and
    the place is skipped (and noted in ``skipped``) once they and those not yet looked for are too few.
    """
    there = [w for w in t.words if w in places]
    if len(there) < t.need:
        return []
    reached: dict[int, int] = {}
    for i, word in enumerate(t.prefix):
        for at in places.get(word, ()):
            held, left = 1, len(t.words) - i - 1
            for w in t.words[i + 1 :]:
                if held + left < t.need or held >= t.need:
                    break
                left -= 1
                held += bool(w in places and _between(places[w], at - t.span + 1, at + t.span))
            if held + left < t.need:
                if skipped is not None:
                    skipped.append(at)
                continue
            near = sorted(
                (p, w) for w in there for p in _between(places[w], at - t.span + 1, at + t.span)
            )
            for k, (start, _) in enumerate(near):
                if start > at:
                    break
                if start in reached:
                    continue
                block = {w for p, w in near[k:] if p < start + t.span}
                if len(block) >= t.need:
                    reached[start] = len(block)
    return [(held, start) for start, held in sorted(reached.items())]


def best_block(places: dict[str, list[int]], t: Template) -> tuple[int, int] | None:
    """The first of the blocks of ``all_blocks`` with most words."""
    return min(all_blocks(places, t), key=lambda b: (-b[0], b[1]), default=None)


def _between(places: list[int], low: int, high: int) -> list[int]:
    return places[bisect_left(places, low) : bisect_left(places, high)]


def scan(text: str, phrases: dict[str, str], templates: list[Template], wanted: frozenset[str]):
    """The result of one text; see ``licence_scan``."""
    words = words_of(text)
    places: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        if w in wanted:
            places.setdefault(w, []).append(i)
    starts, base = [], set()
    for phrase, label in phrases.items():
        found = phrase_places(words, places, phrase)
        starts += found
        if found:
            base.add(label)
    labels, score, blocks = set(base), 1.0 if base else 0.0, []
    for t in templates:
        for held, start in all_blocks(places, t):
            contained = held / len(t.words)
            labels.add(t.label)
            score = max(score, contained)
            blocks.append({"label": t.label, "start": start, "containment": contained})
    return {
        "n_words": len(words),
        "n_base": len(starts),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(labels)),
        "score": score,
        "blocks": blocks,
    }


BLOCKS = "array<struct<label:string,start:long,containment:double>>"
FOUND = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string,"
    f" labels string, score double, blocks {BLOCKS}"
)
ARROW = {
    "long": pa.int64(), "string": pa.string(), "double": pa.float64(),
    BLOCKS: pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("containment", pa.float64())])),
}


def _scanned(batch: pa.RecordBatch, **what) -> pa.RecordBatch:
    found = [scan(text, **what) for text in texts(batch.column("text"))]
    names = [c.strip().split(" ", 1) for c in re.split(r",(?= )", FOUND)]
    return columns(
        doc_id=batch.column("doc_id"),
        **{n: pa.array([f[n] for f in found], ARROW[kind]) for n, kind in names},
    )


def licence_scan(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    phrases: dict[str, str] | None = None,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    containment: float = 0.85,
    slack: float = 1.25,
) -> DataFrame:
    """One row per document: phrase places, labels, score and all blocks.

    A block is ``slack`` times as long as its template. ``score`` is the largest
    containment found, 1 where a phrase stands, 0 where nothing reaches the
    threshold. ``blocks`` has every block that reaches the threshold, by template and
    start, none folded: one notice may give several that overlap. A null text is empty; null ids and repeated rows are documents like
    others; other columns are not looked at; an empty table gives no rows.

    Two passes over the texts: one counts the templates' words, whose number the
    templates bound, over all documents; one joins. Templates travel with the task.
    """
    phrases = PHRASES if phrases is None else phrases
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    vocabulary = frozenset(w for _, t in templates for w in words_of(t))
    counts = map_batches(
        source.select("text"), partial(_counted, vocabulary=vocabulary), "word string, n long"
    ).groupBy("word").agg(F.sum("n").alias("n"))
    in_order = ordered(templates, dict(map(tuple, counts.collect())), containment, slack)
    what = {
        "phrases": phrases,
        "templates": in_order,
        "wanted": vocabulary | {w for p in phrases for w in p.split()},
    }
    kind = source.schema["doc_id"].dataType.simpleString()
    return map_batches(source, partial(_scanned, **what), f"doc_id {kind}, {FOUND}")


def op3_licences(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return licence_scan(docs).drop("blocks")


_TEMPLATE_ROWS = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(TEMPLATES))
OP3_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), w AS (
  SELECT r, generate_subscripts(words, 1) - 1 AS k, unnest(words) AS word FROM d
), n AS (
  SELECT r, k, word, lead(word) OVER o AS word2, lead(word, 2) OVER o AS word3
  FROM w WINDOW o AS (PARTITION BY r ORDER BY k)
), base AS (
  SELECT r, k, CASE WHEN word = 'mit' THEN 'mit' WHEN word = 'apache' THEN 'apache' ELSE 'gpl' END AS label
  FROM n WHERE (word IN ('mit', 'apache') AND word2 = 'license')
    OR (word = 'general' AND word2 = 'public' AND word3 = 'license')
), t AS (
  SELECT *, string_split(words, ' ') AS run, list_distinct(string_split(words, ' ')) AS bag
  FROM (VALUES {_TEMPLATE_ROWS}) AS v(t, label, words)
), tw AS (
  SELECT t, label, len(bag) AS size, ceil(0.85 * len(bag) - 1e-9) AS need,
    ceil(1.25 * len(run)) AS span, unnest(bag) AS word FROM t
), hit AS (
  SELECT r, k, w.word, t, label, size, need, span FROM w JOIN tw ON w.word = tw.word
), enough AS (
  SELECT r, t FROM hit GROUP BY r, t HAVING count(DISTINCT word) >= any_value(need)
), block AS (
  SELECT a.r, a.label, count(DISTINCT b.word) / a.size AS contained
  FROM hit a JOIN enough e ON a.r = e.r AND a.t = e.t
    JOIN hit b ON a.r = b.r AND a.t = b.t AND b.k >= a.k AND b.k < a.k + a.span
  GROUP BY a.r, a.t, a.k, a.label, a.size, a.need HAVING count(DISTINCT b.word) >= a.need
), bs AS (
  SELECT r, count(*) AS n, min(k) AS first_word, max(k) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY r
), al AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT r, label FROM base UNION SELECT r, label FROM block) GROUP BY r
), sc AS (
  SELECT r, max(contained) AS score FROM block GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(bs.n, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(bs.labels, '') AS base_labels, coalesce(al.labels, '') AS labels,
  CASE WHEN bs.n > 0 THEN 1.0 ELSE coalesce(sc.score, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN bs USING (r) LEFT JOIN al USING (r) LEFT JOIN sc USING (r)
"""
