"""Most and least frequent value of columns without shuffling all their values.

Exact, with the tie rule of ``profile``: of equal counts the smallest text, null first.

*Most frequent.* One pass counts every column's values in ``2 ** bits`` hash buckets; a bucket's count
bounds the count of each value in it from above. The values of the fullest buckets are counted exactly,
which bounds the top count from below. The second pass counts only values whose bucket can reach that
bound (and holds two rows at least: if no value is seen twice, the answer is the smallest one). Each
task counts into an array of its own and arrays are added up block by block, so what is shuffled is
bounded by the arrays and by the rows that may win, not by the number of values. A column with a clear
favourite, or with no more values than buckets, shuffles next to nothing; one with far more values than
buckets, all about equally frequent, shuffles them as an ordinary count does.

*Least frequent.* Rows are walked in the order of their text, ``walk_rows`` at a time (each task keeps its
first ones): a value that is seen once and followed by another is the answer, as no smaller text is seen
once. Columns without such a value early on (as those of few values) are counted in full: what they
shuffle is one row per value and task.

Each column is read by itself, so on columnar files no pass reads a column twice.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualia.functions.predicates import COMPLEX_TYPES, as_text, field_type, qcol, resolve_name
from qualia.session import scratch_path

EXTREME_COLUMNS = ["column_name", "most_freq_value", "most_freq_value_count", "least_freq_value", "least_freq_value_count"]
_BLOCK = 1 << 14
_SALTS = 16
_FULLEST = 8  # buckets whose values give the lower bound
_TOGETHER = 8  # columns counted in one pass: their arrays are in a task's memory


def _bucket(text: Column, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(text), 64 - bits).cast("int")


def _packed_block(b: int, counts: np.ndarray) -> pa.RecordBatch:
    data = zlib.compress(np.minimum(counts, np.iinfo(np.uint32).max).astype("<u4").tobytes(), 1)
    return pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([data], pa.binary())], names=["block", "counts"])


def _added(batches: Iterable[pa.RecordBatch]) -> dict[int, np.ndarray]:
    """The sums of the blocks of a task."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, data in zip(batch.column("block").to_pylist(), batch.column("counts")):
            own = np.frombuffer(zlib.decompress(data.as_py()), dtype="<u4").astype(np.uint64)
            total[b] = total[b] + own if b in total else own
    return total


def _counts_together(df: DataFrame, texts: Sequence[Column], first: int, bits: int) -> DataFrame:
    size, block, width = 1 << bits, min(_BLOCK, 1 << bits), len(texts)
    per_column = size // block

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size * width, dtype=np.int64)
        waiting: list[pa.RecordBatch] = []

        def flush() -> None:
            for k in range(width if waiting else 0):
                own = np.concatenate([b.column(k).to_numpy() for b in waiting])
                counts[k * size:(k + 1) * size] += np.bincount(own, minlength=size)
            waiting.clear()

        rows = 0
        for batch in batches:
            waiting.append(batch)
            rows += batch.num_rows
            if rows >= size:  # a pass over the array takes as long as counting some hundred batches
                flush()
                rows = 0
        flush()
        for b in np.unique(np.flatnonzero(counts) // block).tolist():
            yield _packed_block(b, counts[b * block:(b + 1) * block])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, counts in _added(batches).items():
            yield _packed_block(b, counts)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, counts in _added(batches).items():
            at = np.flatnonzero(counts > 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), first + b // per_column, np.int32)), pa.array((b % per_column * block + at).astype(np.int32)),
                 pa.array(counts[at].astype(np.int64))], names=["k", "bucket", "n"])

    schema = "block int, counts binary"
    src = df.select(*[_bucket(t, bits).alias(f"b{i}") for i, t in enumerate(texts)])
    src = src.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism)  # an array per task
    arrays = src.mapInArrow(count, schema).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(_SALTS)))
    arrays = arrays.repartition("block", "salt").select("block", "counts").mapInArrow(add, schema)
    return arrays.repartition("block").mapInArrow(rows, "k int, bucket int, n long")


def bucket_counts(df: DataFrame, texts: Sequence[Column], bits: int) -> DataFrame:
    """``k, bucket, n`` of the buckets with two rows or more, for column number ``k`` of ``texts`` (written)."""
    path = scratch_path(df.sparkSession, "bucket-counts")
    for first in range(0, len(texts), _TOGETHER):
        _counts_together(df, texts[first:first + _TOGETHER], first, bits).write.mode("append").parquet(path)
    return df.sparkSession.read.schema("k int, bucket int, n long").parquet(path)


def _values_in(df: DataFrame, texts: Sequence[Column], buckets: DataFrame, bits: int) -> DataFrame:
    """``k, v`` of the rows in ``buckets`` (k, bucket): at most ``2 ** bits`` a column, broadcast column by column."""
    out = None
    for k, text in enumerate(texts):
        own = buckets.where(F.col("k") == k).select(F.col("bucket").alias("_bucket"))
        rows = df.select(text.alias("v"), _bucket(text, bits).alias("_bucket")).join(F.broadcast(own), "_bucket", "left_semi")
        rows = rows.select(F.lit(k).alias("k"), "v")
        out = rows if out is None else out.unionByName(rows)
    return out


def contenders(df: DataFrame, texts: Sequence[Column], bits: int) -> DataFrame:
    """``k, v`` of the rows whose value may be its column's most frequent one: what the second pass shuffles."""
    counts = bucket_counts(df, texts, bits)
    place = F.row_number().over(Window.partitionBy("k").orderBy(F.desc("n"), "bucket"))
    fullest = counts.withColumn("place", place).where(F.col("place") <= _FULLEST).select("k", "bucket")
    sure = _values_in(df, texts, fullest, bits).groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).groupBy("k").agg(F.max("n").alias("least"))
    least = {r.k: r.least for r in sure.collect()}  # one number per column
    bound = F.coalesce(*[F.when(F.col("k") == k, F.lit(n)) for k, n in least.items()], F.lit(0))
    return _values_in(df, texts, counts.where(F.col("n") >= bound).select("k", "bucket"), bits)


def most_frequent(df: DataFrame, texts: Sequence[Column], bits: int) -> list[tuple[str | None, int]]:
    """Most frequent value and its count, per column."""
    counted = contenders(df, texts, bits).groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy("k").agg(F.min(F.struct((-F.col("n")).alias("neg"), "v")).alias("b"))
    found = {r.k: (r.b.v, -r.b.neg) for r in best.collect()}  # one row per column
    out = []
    for k, text in enumerate(texts):
        if found.get(k, (None, 0))[1] < 2:  # no value is seen twice: the smallest text, null first
            first = df.select(text.alias("v")).agg(F.min(F.struct(F.col("v").isNotNull(), "v")).alias("s"), F.count(F.lit(1)).alias("n")).first()
            found[k] = (first.s.v, 1) if first.n else (None, 0)
        out.append(found[k])
    return out


def least_frequent(df: DataFrame, text: Column, walk_rows: int, walks: int) -> tuple[str | None, int]:
    """Least frequent value and its count of one column."""
    values = df.select(text.alias("v"))
    rest = values
    for _ in range(walks):
        near = rest.orderBy(F.asc_nulls_first("v")).limit(walk_rows)
        seen = near.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        order = F.struct(F.col("v").isNotNull().alias("set"), F.col("v").alias("v"), F.col("n").alias("n"))
        # in one job: the table is read once a walk
        one = seen.agg(F.max(order).alias("last"), F.sum("n").alias("rows"), F.min(F.when(F.col("n") == 1, order)).alias("single")).first()
        if not one.rows:
            break
        whole = one.rows < walk_rows  # the walk met the end
        last, single = one.last, one.single
        # more rows of the last value may follow; if the smallest single value is the last one, no other is single
        if single is not None and (whole or single != last):
            return single.v, 1
        if whole or last.v is None and last.n == 1:
            break
        # values that were seen twice are none that is seen once
        rest = rest.where(F.col("v") > F.lit(last.v) if last.n > 1 and last.v is not None else
                          F.col("v").isNotNull() if last.v is None else F.col("v") >= F.lit(last.v))
    best = values.groupBy("v").agg(F.count(F.lit(1)).alias("n")).agg(F.min(F.struct("n", "v")).alias("b")).first().b
    return (best.v, best.n) if best else (None, 0)


def frequency_extremes(df: DataFrame, cols: Sequence[str] | None = None, bits: int = 20, walk_rows: int = 10_000,
                       walks: int = 2) -> DataFrame:
    """One row per column: its most and its least frequent value (text) and their counts. Null is a value; a table
    without rows has null values and counts of 0. Jobs run when it is called: two passes per column and the walk."""
    names = [resolve_name(df, c) for c in cols] if cols else list(df.columns)
    for c in names:
        if isinstance(field_type(df, c), COMPLEX_TYPES):
            raise TypeError(f"column {c!r} has a complex type; frequencies need atomic columns")
    texts = [as_text(qcol(c), field_type(df, c)) for c in names]
    most, least = most_frequent(df, texts, bits), [least_frequent(df, t, walk_rows, walks) for t in texts]
    rows = [(c, *m, *x) for c, m, x in zip(names, most, least)]
    schema = T.StructType([T.StructField(c, T.LongType() if c.endswith("count") else T.StringType()) for c in EXTREME_COLUMNS])
    return df.sparkSession.createDataFrame(rows, schema)
