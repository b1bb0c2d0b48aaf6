"""A training-corpus pipeline over ``documents``: each stage works on all rows its predecessor kept.

A stage's output is written as Parquet and read again as the next one's input. All stages but the
last return the columns of documents; the last returns packed pieces with their token ids.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from qualia.llm import digest_index, jaccard_join, ordinal_quality, ss_pack, zstd_language
from qualia.llm.queries import WORD_BPE, grades
from qualia.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier takes for the top grade (good and not toxic)."""
    labels = spark.read.parquet(os.path.join(sf_dir, "labels.parquet"))
    return ordinal_quality.keep_good(docs, ordinal_quality.fit(docs, grades(labels)))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language compression tells apart; dictionaries are learned from the input's lang."""
    return zstd_language.keep_identified(docs, zstd_language.learn_dictionaries(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return digest_index.DigestIndex(spark).keep(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return jaccard_join.JaccardJoin(docs).keep_first()


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into windows of 2048 ids."""
    return ss_pack.pack(docs, public_tokenizers.path(WORD_BPE), size=2048, end_id=1)


STAGES = [("quality", quality), ("language", language), ("exact", exact), ("near", near), ("pack", pack)]

# SQL cannot express training, compression and packing: tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
