"""Shared pieces of the registered queries: table loading and the fixed run stamp."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Fixed run stamp of the registered queries, so run_date columns are repeatable.
RUN_TS = "2024-01-01 00:00:00"

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables (vectorized scan, filter/column pushdown)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
