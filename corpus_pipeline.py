"""A training corpus from documents, stage by stage.

Toxic documents go, one document of each near-duplicate class stays, passages
that an earlier document has are cut, sources are mixed to their weights, and
what is left is encoded and decoded again. Every stage works on all that the one before kept, and
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tripmart.llm.bpe import encoded
from tripmart.llm.mixing import mixed
from tripmart.llm.near_duplicates import deduplicated
from tripmart.llm.substrings import without_repeats
from tripmart.llm.toxicity import without_toxic
from tripmart.llm.workers import free
from tripmart.storage import ensure_checkpoint_dir

VOCABULARY = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the least id stays."""
    return deduplicated(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 13-word windows that a document with a smaller id has go from the text."""
    return without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256, decoded_sha256`` of each document taken."""
    return encoded(
        docs, public_tokenizers.path(VOCABULARY), results=("n_tokens", "ids", "ids_sha256", "decoded_sha256")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("mixing sources", mix_sources),
    ("bpe encoding", encode),
]

# A fitted scorer, hashed signatures and an encoder are beyond SQL; tests hold
# the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage keeps is checkpointed before the next reads it, its shuffle files are freed."""
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).checkpoint()
        free(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
