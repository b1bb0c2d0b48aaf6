"""Line deduplication over levelled sorted runs of line hashes.

A line's key is its bytes without ASCII white space at both ends, A-Z lower-cased; the runs hold the
128-bit hash of each key with the number of documents it was found in, as tables bucketed and sorted
by hash. A new batch of documents is counted (one row per distinct key), merge-joined with the runs
and cut down by the anti join to the keys that are not yet common there (``min_docs`` documents),
and added as a run of level 0. When a level has ``fanout`` runs they are merged into one run of the
next level. Keys that reach ``min_docs`` are the common lines; ``drop_common`` removes all their
lines from every document.

To rewrite documents, only lines that may be common (by a fixed-size bucket filter) leave the scan,
as (text hash, line hash); they are joined with the common keys and meet the documents again by text
hash. Copies of a text share that row, and adaptive skew handling can split the documents' side.

Defined results: null or empty text is one empty line; empty keys are never dropped; a key counts
once per row, repeated rows count each; a document that loses all lines has the empty text; an
empty table gives no rows; other columns are not read. ``line_runs`` of an empty store has no rows.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualia.llm.batches import slices
from qualia.llm.sketch import bucket_counts
from qualia.session import scratch_path

_BLANK = b" \t\n\x0b\x0c\r"


def line_keys(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """The lines of a text in UTF-8 and each line's key hash (empty key: b'')."""
    lines = (text or "").encode().split(b"\n")
    keys = [line.strip(_BLANK).lower() for line in lines]
    return lines, [xxhash.xxh3_128_digest(k) if k else b"" for k in keys]


def _keys_per_document(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found: list[bytes] = []
        for text in batch.column("text").to_pylist():
            found.extend({k for k in line_keys(text)[1] if k})
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["key"])


class LineRuns:
    """Levelled runs under ``path``; ``levels`` lists the live run tables, newest last."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, min_docs: int = 10,
                 fanout: int = 4):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.path = path or scratch_path(spark, "line-runs")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def _write(self, run: DataFrame, level: int) -> None:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = f"{self.path}/level-{level}/{name}"
        (
            run.select("key", "n_docs").repartition(self.buckets, "key").write.format("parquet")
            .bucketBy(self.buckets, "key").sortBy("key").option("path", self.paths[name]).saveAsTable(name)
        )
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _merged(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], "key binary, n_docs long")
        if len(names) == 1:
            return self.spark.table(names[0])
        # Read by path: a union of bucketed tables is taken for bucketed itself, and then equal keys
        # of two runs are not brought together.
        runs = [self.spark.read.schema("key binary, n_docs long").parquet(self.paths[n]) for n in names]
        return reduce(DataFrame.unionAll, runs).groupBy("key").agg(F.sum("n_docs").alias("n_docs"))

    def line_runs(self) -> DataFrame:
        """All runs merged: key, n_docs (no less than min_docs once a key is common)."""
        return self._merged([n for level in self.levels for n in level])

    def add(self, docs: DataFrame, text_col: str = "text") -> None:
        """Count a batch of documents and add its run; compacts levels that are full."""
        keys = docs.select(F.col(text_col).alias("text")).mapInArrow(_keys_per_document, "key binary")
        batch = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"))
        common = self.line_runs().where(F.col("n_docs") >= self.min_docs)
        self._write(batch.join(common.select("key"), "key", "left_anti"), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            names, self.levels[level] = self.levels[level], []
            self._write(self._merged(names), level + 1)
            level += 1

    def common(self) -> DataFrame:
        """Keys found in ``min_docs`` documents or more."""
        return self.line_runs().where(F.col("n_docs") >= self.min_docs).select("key")

    def drop_common(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True,
                    filter_bits: int = 20) -> DataFrame:
        """Per document: doc_id, n_lines, n_dropped, kept_sha256 (and ``kept_text``)."""
        path = scratch_path(self.spark, "common-lines")
        self.common().write.parquet(path)
        common = self.spark.read.schema("key binary").parquet(path)
        shift = 64 - filter_bits

        def bucket(keys: pa.Array) -> np.ndarray:
            return (np.frombuffer(b"".join(k[:8] for k in keys.to_pylist()), dtype="<u8") >> np.uint64(shift)).astype(np.int64)

        seen = self.spark.sparkContext.broadcast(bucket_counts(common, lambda b: bucket(b.column("key")), filter_bits) > 0)

        def maybe_common(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            marked = seen.value
            for batch in slices(batches):
                texts, keys = [], []
                for text in batch.column("text").to_pylist():
                    own = {k for k in line_keys(text)[1] if k and marked[int.from_bytes(k[:8], "little") >> shift]}
                    texts.extend([xxhash.xxh3_128_digest((text or "").encode())] * len(own))
                    keys.extend(own)
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array(keys, pa.binary())], names=["tkey", "key"])

        def with_key(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                own = [xxhash.xxh3_128_digest((t or "").encode()) for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.binary())], names=["doc_id", "text", "tkey"])

        def rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                out: list[list] = [[], [], [], []]
                for text, drop in zip(batch.column("text").to_pylist(), batch.column("drop").to_pylist()):
                    kept, n = (text or "").encode(), (text or "").count("\n") + 1
                    left = n
                    if drop:
                        gone = set(drop)
                        lines = [line for line, k in zip(*line_keys(text)) if k not in gone]
                        kept, left = b"\n".join(lines), len(lines)
                    for column, value in zip(out, (n, n - left, hashlib.sha256(kept).hexdigest(), kept.decode())):
                        column.append(value)
                arrays = [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.string(), pa.string())))]
                names = ["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept_text"]
                yield pa.RecordBatch.from_arrays(arrays[:5 if with_text else 4], names=names[:5 if with_text else 4])

        src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        pairs = src.select("text").mapInArrow(maybe_common, "tkey binary, key binary").join(common, "key")
        drops = pairs.groupBy("tkey").agg(F.collect_set("key").alias("drop"))
        schema = "doc_id long, n_lines long, n_dropped long, kept_sha256 string" + (", kept_text string" if with_text else "")
        return (
            src.mapInArrow(with_key, "doc_id long, text string, tkey binary").join(drops, "tkey", "left")
            .select("doc_id", "text", "drop").mapInArrow(rewrite, schema)
        )
