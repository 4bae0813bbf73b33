"""From raw documents to packed sequences: quality rules, line dedup, near-dedup, suffix-array dedup, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fleetmeter.llm import line_dedup, near_duplicates, packing, quality, suffix_dedup
from fleetmeter.llm.common import stored


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that no quality rule rejects."""
    return quality.filter_documents(docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the line chunks that an earlier one has."""
    return line_dedup.replace_texts(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return near_duplicates.keep_one(docs)


def drop_copied_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the strings of 50 bytes or more that an earlier one has."""
    return suffix_dedup.replace_texts(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document: where its tokens are in the sequences to train on, and the tokens."""
    path = public_tokenizers.path
    files = path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return packing.pack_documents(docs, *files, ids=True)


STAGES = [
    ("quality_rules", filter_quality),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_array_dedup", drop_copied_strings),
    ("best_fit_packing", pack),
]

#: Near-duplicate classes and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over the written result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
