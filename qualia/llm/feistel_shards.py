"""Sharding by a keyed Feistel permutation of global row numbers.

Rows are numbered 0..N-1 in the order (doc_id, text hash, input position) by a range shuffle of narrow
rows: a row's number is the count of all earlier partitions' rows plus its place in its own. The
number goes through a Feistel network over the smallest power of two that holds N, and is sent
through it again while the result is not below N (cycle walking), which makes the network a
permutation of 0..N-1. Row number r then sits in shard ``p % shards`` at slot ``p // shards`` for its
permuted number p: shard sizes differ by one at most and slots have no gaps.

Nothing is stored to find a row again: ``Feistel.place`` computes shard and slot of a row number, and
``Feistel.row_at`` the row number of a shard and slot. The same seed and rows give the same shuffle
on any number of partitions.

Defined results: null text has no bytes (size is the fixed part alone, crc32 0); null doc_ids are
numbered first; rows with equal doc_ids are ordered by text hash, and rows that repeat both are told
apart by input position (any order gives the same set of places). Very long texts are only read for
their size and checksum. An empty table gives no rows; other columns are not read by ``assign`` and
kept, whatever their names, in the struct ``doc`` by ``write_shards``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qualia.llm.batches import mix
from qualia.session import scratch_path

_PLACE_BITS = 33  # monotonically_increasing_id keeps the place in a partition in its lower 33 bits


class Feistel:
    """A permutation of 0..n-1 given by ``seed``; vectorised in both directions."""

    def __init__(self, n: int, seed: int = 0, rounds: int = 8):
        bits = max(2, (n - 1).bit_length())
        self.n, self.low = n, np.uint64(bits // 2)
        self.low_mask, self.high_mask = np.uint64((1 << bits // 2) - 1), np.uint64((1 << (bits - bits // 2)) - 1)
        digest = [hashlib.sha256(f"{seed}:{i}".encode()).digest() for i in range(rounds)]
        self.keys = [np.uint64(int.from_bytes(d[:8], "little")) for d in digest]

    def _network(self, x: np.ndarray, backwards: bool) -> np.ndarray:
        high, low = x >> self.low, x & self.low_mask
        turns = list(enumerate(self.keys))
        for i, key in reversed(turns) if backwards else turns:
            if i % 2:
                low = low ^ (mix(high ^ key) & self.low_mask)
            else:
                high = high ^ (mix(low ^ key) & self.high_mask)
        return high << self.low | low

    def _walk(self, x, backwards: bool) -> np.ndarray:
        out = np.array(x, dtype=np.uint64)
        if (out >= self.n).any():
            raise ValueError(f"numbers must be in 0..{self.n - 1}")
        open_ = np.arange(len(out))
        while len(open_):
            out[open_] = self._network(out[open_], backwards)
            open_ = open_[out[open_] >= self.n]
        return out.astype(np.int64)

    def permute(self, rows) -> np.ndarray:
        return self._walk(rows, False)

    def invert(self, numbers) -> np.ndarray:
        return self._walk(numbers, True)

    def place(self, row: int, shards: int) -> tuple[int, int]:
        """Shard and slot of a row number."""
        p = int(self.permute([row])[0])
        return p % shards, p // shards

    def row_at(self, shard: int, slot: int, shards: int) -> int:
        """The row number at a shard and slot."""
        return int(self.invert([slot * shards + shard])[0])


def number_rows(docs: DataFrame, id_col: str, text_col: str, with_rows: bool) -> tuple[DataFrame, int]:
    """Written rows (doc_id, size of the text, text_crc32, row and, if asked for, ``doc``: all columns), and their number."""
    spark, text = docs.sparkSession, F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("at"),
        *([F.struct(*docs.columns).alias("doc")] if with_rows else []))
    order = ["doc_id", "h", "at"]
    path = scratch_path(spark, "numbered-rows")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    placed = src.repartitionByRange(*order).sortWithinPartitions(*order).drop("h", "at")
    placed.withColumns({"part": F.spark_partition_id(), "place": place}).write.parquet(path)
    placed = spark.read.parquet(path)
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("k"))
    n = counts.agg(F.sum("k")).first()[0] or 0
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    bases = counts.select("part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("base"))
    return placed.join(F.broadcast(bases), "part").withColumn("row", F.col("base") + F.col("place")).drop("part", "place", "base"), n


def _placed(numbered: DataFrame, n: int, shards: int, seed: int) -> DataFrame:
    feistel = Feistel(n, seed)

    @F.pandas_udf("long")
    def permuted(rows: pd.Series) -> pd.Series:
        return pd.Series(feistel.permute(rows.to_numpy()))

    out = numbered.withColumn("p", permuted("row"))
    return out.withColumns({"shard": (F.col("p") % shards).cast("int"), "slot": F.expr(f"p div {int(shards)}")}).drop("p")


def assign(docs: DataFrame, shards: int, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """Per row: doc_id, size (UTF-8 bytes of the text plus ``overhead``), text_crc32, row (global number), shard, slot."""
    numbered, n = number_rows(docs, id_col, text_col, with_rows=False)
    return _placed(numbered, n, shards, seed).select(
        "doc_id", (F.col("size") + overhead).alias("size"), "text_crc32", "row", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int, seed: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write whole rows under ``path/shard=K``: columns slot and ``doc``, sorted by slot. A shard of any
    size is written by several tasks (files of consecutive slots)."""
    numbered, n = number_rows(docs, id_col, text_col, with_rows=True)
    placed = _placed(numbered, n, shards, seed).select("shard", "slot", "doc")
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
