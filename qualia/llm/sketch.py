"""Counts per hash bucket over a whole table: a fixed-size array whatever the table's size."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BLOCK_BITS = 14
_SALTS = 16


def bucket_counts(rows: DataFrame, buckets_of: Callable[[pa.RecordBatch], np.ndarray], bits: int = 20,
                  split: Callable[[Iterable[pa.RecordBatch]], Iterable[pa.RecordBatch]] = iter) -> np.ndarray:
    """``2 ** bits`` counts (4 bytes each, saturating) of the buckets ``buckets_of`` gives for each batch; ``split``
    may cut batches smaller first.

    Each task counts into an array of its own; arrays travel in compressed blocks and are added while they
    stream, first per (block, salt) and then per block, so no task holds more than the array.
    """
    block = min(1 << bits, 1 << _BLOCK_BITS)
    top = np.iinfo(np.uint32).max

    def emit(counts: np.ndarray, found: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(found):
            data = [zlib.compress(np.minimum(counts[b * block:(b + 1) * block], top).astype("<u4").tobytes(), 1) for b in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.astype(np.int32)), pa.array(data, pa.binary())], names=["block", "counts"])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, dtype=np.uint64)
        for batch in split(batches):
            np.add.at(counts, buckets_of(batch), np.uint64(1))
        yield from emit(counts, np.unique(np.flatnonzero(counts) // block))

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, found = np.zeros(1 << bits, dtype=np.uint64), set()
        for batch in batches:
            for b, data in zip(batch.column("block").to_pylist(), batch.column("counts")):
                counts[b * block:(b + 1) * block] += np.frombuffer(zlib.decompress(data.as_py()), dtype="<u4")
                found.add(b)
        yield from emit(counts, np.array(sorted(found), dtype=np.int64))

    schema = "block int, counts binary"
    parts = rows.mapInArrow(count, schema).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(_SALTS)))
    parts = parts.repartition("block", "salt").select("block", "counts").mapInArrow(add, schema)
    total = parts.repartition("block").mapInArrow(add, schema)
    out = np.zeros(1 << bits, dtype=np.uint32)
    for row in total.collect():  # 2 ** bits counts at most
        out[row.block * block:(row.block + 1) * block] = np.frombuffer(zlib.decompress(row.counts), dtype="<u4")
    return out
