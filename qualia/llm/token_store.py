"""Token-id output as ORC, in ascending document order.

``write_token_store`` range-partitions documents by id, sorts each partition, encodes every whole
text and writes ORC: the id lists are run-length encoded integers in stripes, each stripe has a row
index (``row_index_stride`` rows) and Bloom filters on the document id. Stripes are the unit of
parallel reads, and a filter on ``doc_id`` prunes stripes and row groups by their statistics and
Bloom filters (``read_token_store(ids=...)``).

Stored columns: ``doc_id``, ``part`` (the range partition, ascending with doc_id), ``part_start``
(ids in the partition before this document), ``n_tokens``, ``ids`` (with the end id). A document's
global start is the sum of the earlier partitions' tokens plus ``part_start``; only one row per
partition is summed for it.

Defined results: null text is the empty text (one end id); null doc_ids come first; equal doc_ids
are ordered by text hash and then input position; an empty table gives an empty store; other
columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qualia.llm.batches import slices
from qualia.llm.word_bpe import SLICE, WordBpe

STORED = "doc_id long, part int, part_start long, n_tokens int, ids array<int>"


def write_token_store(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, id_col: str = "doc_id",
                      text_col: str = "text", stripe_bytes: int = 16 << 20, row_index_stride: int = 1000) -> None:
    """Encode all documents with the tokenizers file ``tokenizer`` and write the store to ``path``."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    src = src.withColumn("h", F.xxhash64("text")).withColumn("at", F.monotonically_increasing_id())
    order = ["doc_id", "h", "at"]

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe.of(tokenizer)
        part, start = TaskContext.get().partitionId(), 0
        for batch in slices(batches, max_bytes=SLICE):
            ids, bounds = bpe.encode_column(batch.column("text"))
            sizes, offsets = np.diff(bounds) + 1, bounds + np.arange(len(bounds))
            values = pa.array(np.insert(ids, bounds[1:], end_id).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(len(sizes), part, dtype=np.int32)),
                    pa.array(start + offsets[:-1]),
                    pa.array(sizes.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values),
                ],
                names=["doc_id", "part", "part_start", "n_tokens", "ids"],
            )
            start += int(offsets[-1])

    (
        src.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
        .mapInArrow(encode, STORED)
        .write.option("orc.stripe.size", str(stripe_bytes))
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(row_index_stride))
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_token_store(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """The stored rows; ``ids`` is pushed into the scan, where it prunes stripes and row groups."""
    stored = spark.read.schema(STORED).orc(path)
    return stored if ids is None else stored.where(F.col("doc_id").isin(ids))


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per stored document: doc_id, start (ids of all documents before it), n_tokens and ids_crc32
    (crc32 of its ids as little-endian unsigned 32-bit integers), all read from the files."""

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            at = ids.offsets.to_numpy().astype(np.int64)
            raw = memoryview(np.ascontiguousarray(ids.values.to_numpy(), dtype="<i4")).cast("B")
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1], at[1:])]
            n = pa.array(np.diff(at))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), batch.column("part_start"), n, pa.array(crc, pa.int64())],
                names=["doc_id", "part", "part_start", "n_tokens", "ids_crc32"],
            )

    rows = read_token_store(spark, path).select("doc_id", "part", "part_start", "ids").mapInArrow(
        digest, "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        spark.read.schema(STORED).orc(path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    return rows.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")
