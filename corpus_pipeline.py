"""From raw documents to token ids: line cleaning, exact and near deduplication, mixing, encoding."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from encore.llm import exact, jaccard, mixing, quality, tokens
from encore.llm.common import delete_folder
from encore.session import ensure_checkpoint_dir

RANKS = "byte_bpe_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their failing lines; those that lose too much, or fail the base signals, go."""
    return quality.cleaned(docs, "text", "n_chars")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact.distinct_texts(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the document with the smallest doc_id stays."""
    return jaccard.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for, up to three times each, in shuffled shards."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and digests of the ids and of the bytes they decode to; a row per row of the mix."""
    encoded = tokens.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return tokens.digests(encoded, "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("source_mix", source_mix),
    ("encode", encode),
]

# SQL has neither the line rules, the Jaccard components nor the encoder; tests/llm/test_pipeline.py compares each
# stage with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; each result is written as Parquet and read again by the next stage.

    A result goes once the next stage's is written, so only the last one stays in the checkpoint folder.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if number:
            delete_folder(spark, f"{folder}/{number - 1}-{STAGES[number - 1][0]}")
        docs = spark.read.parquet(path)
    return docs
