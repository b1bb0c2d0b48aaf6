"""Exact deduplication against a persistent digest index, in DataFrame operations only.

The index is a bucketed table sorted by digest (SHA-256 of the whole text). A batch's digests are
grouped, joined with the index by sort-merge (the index side needs no shuffle), and the groups the
index does not hold (the anti join) are appended to it. Documents then look up their group: that
join is on (digest), and a hot digest is split by adaptive skew handling as it is a plain
shuffled join of narrow rows.

Defined results: null text equals the empty text. Of equal texts of one batch the row with the
largest doc_id stays (null is the smallest; rows repeated with the same id: the last one in input
order); of a text that an earlier batch brought, no row stays. An empty batch gives no rows. Other
columns are not read by ``decide`` and are kept as they are by ``keep``.

A batch must be re-readable in the same row order (files or a checkpoint), since rows are told apart
by their input position.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qualia.llm.batches import free_name
from qualia.session import scratch_path

def text_digest(text: Column) -> Column:
    """SHA-256 of the whole text in UTF-8, as 32 bytes."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


class DigestIndex:
    """A persistent index: files under ``path``, bucketed by digest, read as table ``name`` of the
    session. A path that holds an index is opened again (with the number of buckets it was made with)."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, name: str | None = None):
        self.spark = spark
        self.name = name or f"digest_index_{uuid.uuid4().hex}"
        self.path = path or scratch_path(spark, "digest-index")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        location = self.path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id BIGINT, keep_at BIGINT, n BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{location}'")

    def read(self) -> DataFrame:
        """Rows of the index: digest, keep_id, keep_at, n."""
        return self.spark.table(self.name)

    def append(self, groups: DataFrame) -> None:
        """Add groups (digest, keep_id, keep_at, n) that the index does not hold."""
        groups.select("digest", "keep_id", "keep_at", "n").write.mode("append").insertInto(self.name)

    def decide(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Deduplicate one batch and append its new digests.

        One row per document: doc_id, keep_id (of the row that stays, or that an earlier batch kept),
        group_size (rows of that text so far), kept, text_sha256, and its input position ``at``.
        """
        rows = docs.select(
            F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("at"),
            text_digest(F.col(text_col)).alias("digest"))
        path = scratch_path(self.spark, "digests")
        rows.write.parquet(path)
        rows = self.spark.read.schema(rows.schema).parquet(path)
        best = F.max(F.struct("doc_id", "at"))
        groups = rows.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("n")).select(
            "digest", F.col("best.doc_id").alias("keep_id"), F.col("best.at").alias("keep_at"), "n")
        known = self.read().select("digest", F.col("keep_id").alias("old_id"), F.col("n").alias("old_n"))
        state = scratch_path(self.spark, "digest-groups")
        groups.join(known.withColumn("old", F.lit(True)), "digest", "left").write.parquet(state)
        state = self.spark.read.parquet(state)
        self.append(state.where("old is null"))
        found = state.select(
            "digest", F.when(F.col("old"), F.col("old_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            (F.coalesce("old_n", F.lit(0)) + F.col("n")).alias("group_size"),
            F.when(F.col("old"), F.lit(None)).otherwise(F.col("keep_at")).alias("keep_at"))
        return rows.join(found, "digest").select(
            "doc_id", "keep_id", "group_size", F.coalesce(F.col("at") == F.col("keep_at"), F.lit(False)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"), "at")

    def keep(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """The rows of a batch that stay, with all their columns."""
        at = free_name(docs.columns, "at")
        kept = self.decide(docs, id_col, text_col).where("kept").select(F.col("at").alias(at))
        return docs.withColumn(at, F.monotonically_increasing_id()).join(kept, at, "left_semi").drop(at)
