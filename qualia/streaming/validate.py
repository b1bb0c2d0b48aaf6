"""Rule validation over Structured Streaming sources.

The same operators as batch (``row_results``, ``rule_metrics``) accept a streaming
DataFrame:

* ``stream_row_results``: stateless, one output row per input row and rule (append mode);
* ``stream_rule_metrics``: running totals per rule, a global streaming aggregation whose
  state is one row of counters (complete or update mode). Rules needing a distinct count
  (aggregate ``uniqueness``/``distinctness``) are refused: an exact streaming distinct
  count would keep every key in state. Run those in batch over the sink table.

``run_available`` drives a query over everything available now (``availableNow`` trigger)
and writes each micro-batch's complete result with ``foreachBatch``, overwriting a
Parquet snapshot (idempotent, so a retried batch leaves the same table). Checkpoints and
snapshots live under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from qualia.operators.validate import as_rules, row_results, rule_metrics
from qualia.session import scratch_path

# Aggregate rules that need only counters in streaming state.
STREAMABLE_AGGREGATES = ("completeness", "hassize")


def stream_row_results(stream_df: DataFrame, rules, pass_through=None, run_ts=None) -> DataFrame:
    """Row results of a streaming DataFrame (append mode)."""
    return row_results(stream_df, rules, pass_through=pass_through, run_ts=run_ts)


def stream_rule_metrics(stream_df: DataFrame, rules) -> DataFrame:
    """Running rule metrics of a streaming DataFrame (complete / update mode)."""
    rs = as_rules(rules)
    bad = [r.rule_name for r in rs if r.is_aggregate and (r.rule or "").strip().lower() not in STREAMABLE_AGGREGATES]
    if bad:
        raise ValueError(f"rules {bad} need distinct counts; run them in batch over the sink table")
    return rule_metrics(stream_df, rs)


def read_stream(spark: SparkSession, directory: str, schema: StructType, fmt: str = "parquet",
                pattern: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over ``directory`` (optionally only files matching ``pattern``)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(directory)


def run_available(result: DataFrame, path: str | None = None, checkpoint: str | None = None,
                  output_mode: str = "complete") -> DataFrame:
    """Run a streaming result over all available input; return the snapshot as a batch table.

    ``complete``: each micro-batch writes the full result as a snapshot of its own; the last is returned.
    ``append`` (stateless results such as row results): each micro-batch writes its own
    ``batch_id=<epoch>`` folder with overwrite, so a retried batch replaces its rows
    instead of adding them twice. An input with no data gives an empty table.
    """
    if output_mode not in ("complete", "append"):
        raise ValueError("output_mode must be 'complete' or 'append' (update mode would keep stale rows)")
    spark = result.sparkSession
    path = path or scratch_path(spark, "stream_snapshot")
    checkpoint = checkpoint or scratch_path(spark, "stream_checkpoint")

    latest: list[str] = []

    def write(batch: DataFrame, epoch_id: int) -> None:
        if output_mode == "complete":
            # each batch writes a folder of its own: a failed write leaves the last snapshot whole
            batch.write.mode("overwrite").parquet(f"{path}/snapshot-{epoch_id}")
            latest.append(f"{path}/snapshot-{epoch_id}")
        else:
            batch.write.mode("overwrite").parquet(f"{path}/batch_id={epoch_id}")

    query = (
        result.writeStream.outputMode(output_mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if output_mode == "complete":
        return spark.read.schema(result.schema).parquet(latest[-1]) if latest else spark.createDataFrame([], result.schema)
    if not _exists(spark, path):  # no micro-batch ran: nothing was written
        return spark.createDataFrame([], result.schema)
    out = spark.read.parquet(path)
    return out.drop("batch_id") if "batch_id" in out.columns else out


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists on the file system its path names."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
