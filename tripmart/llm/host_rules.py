"""Quality rules of documents, and verdicts on whole hosts from their failure rates."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.workers import columns, map_batches, texts
from tripmart.storage import ensure_checkpoint_dir

BLANKS = " \t\n\r\x0b\x0c"
SYMBOLS = "#*$%&|<>"
METRICS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def measure(text: str) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated 3-word windows."""
    words = text.encode("utf-8", "surrogatepass").split()  # ASCII blanks only, as BLANKS
    kept = len(text) - sum(text.count(c) for c in BLANKS)
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    covered = 0
    if len(set(windows)) < len(windows):
        seen: dict[tuple, int] = {}
        for w in windows:
            seen[w] = seen.get(w, 0) + 1
        upto = 0
        for i, w in enumerate(windows):
            if seen[w] > 1:
                covered += i + 3 - max(i, upto)
                upto = i + 3
    symbols = sum(text.count(c) for c in SYMBOLS)
    return len(words), kept, symbols, len(lines) - len(set(lines)), covered


def _measured(batch: pa.RecordBatch, n_keys: int) -> pa.RecordBatch:
    found = list(zip(*map(measure, texts(batch.column("text"))), strict=True)) or [()] * 5
    names = [c.split()[0] for c in METRICS.split(", ")]
    keys = {batch.schema.names[i]: batch.column(i) for i in range(n_keys)}
    return columns(**keys, **{n: pa.array(v, pa.int64()) for n, v in zip(names, found, strict=True)})


#: Documents that a prior is worth where hosts do not differ.
MOST = 1e9


@dataclass(frozen=True)
class Rules:
    """Bounds of the document rules; a document fails if it breaks any of the first two.

    ``max_host_rate``: a host whose shrunk failure rate is above it is rejected.
    """

    min_words: int = 50
    max_repeat_percent: int = 50
    max_host_rate: float = 0.5


def prior(hosts: DataFrame) -> tuple[float, float]:
    """Beta prior ``a, b`` of the hosts' failure rates by beta-binomial moments.

    The spread of the rates, weighted by the hosts' documents, beyond what drawing
    that many documents at the overall rate p gives by itself is the part r of
    p (1 - p) that lies between hosts; the prior is worth (1 - r) / r documents at p. Without such
    a spread (noise only, one host, equal rates) it is worth ``MOST`` documents, so that no host
    differs from the rest. A few sums come to the driver.
    """
    sums = hosts.agg(
        F.count("*").alias("hosts"), F.sum("n").alias("n"), F.sum("failed").alias("failed"),
        F.sum(F.col("n") * F.col("n").cast("double")).alias("squares"),
        F.sum(F.col("failed") * F.col("failed").cast("double") / F.col("n")).alias("between"),
    ).first()
    if not sums["n"]:
        return 0.0, MOST
    k, n, p = sums["hosts"], sums["n"], sums["failed"] / sums["n"]
    noise, room = p * (1 - p) * (k - 1), p * (1 - p) * (n - sums["squares"] / n - (k - 1))
    part = (sums["between"] - n * p * p - noise) / room if room > 0 else 0.0
    size = MOST if part <= 1 / (1 + MOST) else max(1 - part, 0.0) / part
    return p * size, (1 - p) * size


def judged(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    rules: Rules = Rules(),
) -> DataFrame:
    """``doc_id, host``, the measures, ``base_failed, host_rate, host_rejected, kept``.

    One row per input row. Words stand between ASCII blanks. A null or empty text
    has no words and fails; null is a host like others; repeated rows count each;
    other columns are not looked at; an empty table gives no rows. The measures
    are taken once and checkpointed; what is shuffled is a few numbers a document,
    and a hot host's documents meet its verdict in a join that can be split.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    source = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(host)), F.lit("")).alias("key"),
        F.col(text).alias("text"),
    )
    kind = source.schema["doc_id"].dataType.simpleString()
    measured = map_batches(
        source, partial(_measured, n_keys=2), f"doc_id {kind}, key string, {METRICS}"
    ).withColumn(
        "base_failed",
        (F.col("n_words") < rules.min_words)
        | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words")),
    ).checkpoint()
    hosts = measured.groupBy("key").agg(
        F.count("*").alias("n"), F.count_if("base_failed").alias("failed")
    )
    a, b = prior(hosts)
    rate = (F.col("failed") + a) / (F.col("n") + a + b)
    verdicts = hosts.select("key", rate.alias("host_rate"))
    rejected = F.col("host_rate") > rules.max_host_rate
    return measured.join(verdicts, "key").select(
        "doc_id",
        F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)).alias("host"),
        *(c.split()[0] for c in METRICS.split(", ")),
        "base_failed", "host_rate", rejected.alias("host_rejected"),
        (~F.col("base_failed") & ~rejected).alias("kept"),
    )


def op9_host_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judged(docs).drop("host", "host_rate", "host_rejected")


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce('=' || source, '') AS key, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    row_number() OVER () AS r
  FROM documents
), w AS (
  SELECT r, generate_subscripts(words, 1) AS k, unnest(words) AS word FROM d
), g AS (
  SELECT r, k, word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o AS gram
  FROM w WINDOW o AS (PARTITION BY r ORDER BY k)
), twice AS (
  SELECT r, k FROM (SELECT r, k, count(*) OVER (PARTITION BY r, gram) AS n FROM g
                    WHERE gram IS NOT NULL) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT k + i) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS i) GROUP BY r
), lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM d
), dup AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), m AS (
  SELECT doc_id, key, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN dup USING (r) LEFT JOIN covered USING (r)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
), h AS (
  SELECT key, count(*) AS n, count(*) FILTER (WHERE base_failed) AS failed FROM b GROUP BY key
), s AS (
  SELECT count(*) AS k, sum(n)::DOUBLE AS n, sum(failed)::DOUBLE / sum(n) AS p, sum(n * n::DOUBLE) AS squares,
    sum(failed * failed::DOUBLE / n) AS between_hosts
  FROM h
), r AS (
  SELECT p, CASE WHEN p * (1 - p) * (n - squares / n - (k - 1)) > 0
      THEN (between_hosts - n * p * p - p * (1 - p) * (k - 1)) / (p * (1 - p) * (n - squares / n - (k - 1)))
      ELSE 0 END AS part
  FROM s
), ab AS (
  SELECT p * size AS a, (1 - p) * size AS b
  FROM (SELECT p, CASE WHEN part <= 1 / (1 + 1e9) THEN 1e9 ELSE greatest(1 - part, 0) / part END AS size FROM r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (failed + ab.a) / (n + ab.a + ab.b) > 0.5 AS kept
FROM b JOIN h USING (key), ab
"""
