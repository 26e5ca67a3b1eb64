"""Corpus pipeline: the stages over ``documents``, each written as Parquet in
the shared folder and read again as the next stage's input.

Toxic documents go, one document of each group of near copies stays, passages
that repeat across the rest are removed, documents that hold a benchmark item
go, and what is left is encoded. All stages but the last return the columns of
``documents``; a null text is kept by every stage (as one of the group of
documents without words) and encoded as empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm import bpe, decontaminate, jaccard_join, substring_dedup, toxicity
from sparkmart.llm.common import prepare, written
from sparkmart.llm.queries import learn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that the toxicity model, trained on ``labels``, rejects."""
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"), eligible=learn())
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of the n-gram Jaccard join stays: the one of the least id."""
    prepare(spark)
    return jaccard_join.keep_one(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that occur elsewhere are cut out of the texts; ``n_chars`` follows."""
    prepare(spark)
    return substring_dedup.strip_repeats(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that hold an item of ``benchmark``."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_tokens, decoded_sha256) of every document that is left."""
    prepare(spark)
    return bpe.encoded(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", drop_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("byte_bpe", encode),
]

# the trained classifier and the tokenizer are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
