"""Distinct rules over a stream, window by window (A10 on T1).

Uniqueness and distinctness need a count per value. Over an endless stream that state has no bound, so the rules are
answered per tumbling event-time window: a first stateful aggregation keeps one count per (window, value), a second one
adds the counts up per window and element. A watermark bounds both: when it passes a window's end its values are
summed up, emitted once (append mode) and dropped from state. Repeated deliveries of a row can be left out by its id
(``dropDuplicatesWithinWatermark``), whose state is bounded by the same watermark.

Rows that come after their window was closed change nothing in its result. They are counted apart: Spark counts, per
micro-batch, what each stateful operator turned away, and ``run_windows`` returns it. With ``id_col`` the first of
them meets single rows, so it is the number of late rows (those older than the watermark, as a repetition of them could
not be told any more); without, it is that of late (window, element, value) groups.

A hot value costs one state entry per window; the first shuffle is on (window, element, value) with partial counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualia.functions.predicates import as_text, field_type, parse_slo, pct_half_up_sql, qcol, resolve_name, str_lit
from qualia.operators.validate import Rule, as_rules
from qualia.session import scratch_path

# Aggregate rules that are answered per window.
WINDOW_RULES = ("uniqueness", "distinctness", "completeness")


@dataclass(frozen=True)
class WindowRun:
    """Closed windows' results and the rows that came too late for theirs."""

    results: DataFrame
    late_rows: int


def _elements(rules: Sequence[Rule], df: DataFrame) -> dict[str, list[Rule]]:
    by_element: dict[str, list[Rule]] = {}
    for r in rules:
        if (r.rule or "").strip().lower() not in WINDOW_RULES:
            raise ValueError(f"rule {r.rule_name!r}: windows answer {', '.join(WINDOW_RULES)}")
        by_element.setdefault(resolve_name(df, r.element), []).append(r)
    if not by_element:
        raise ValueError("no active rules")
    return by_element


def window_rule_metrics(stream_df: DataFrame, rules, time_col: str, window: str, delay: str, id_col: str | None = None) -> DataFrame:
    """Aggregate rules per tumbling window: ``window_start, window_end`` and the columns of ``rule_metrics``.

    ``uniqueness`` is distinct values / rows, ``distinctness`` distinct values / non-null rows, ``completeness`` non-null rows / rows,
    as in batch. A window is emitted when the watermark (the latest event time seen, less ``delay``) reaches its end.
    ``id_col`` leaves out rows with an id that was seen within the watermark.
    """
    by_element = _elements(as_rules(rules), stream_df)
    time_col = resolve_name(stream_df, time_col)
    naive = isinstance(field_type(stream_df, time_col), T.TimestampNTZType)
    df = stream_df
    if naive:  # event times need a time zone: the wall clock is read as UTC and shown as it was
        df = df.withColumn(time_col, F.from_utc_timestamp(qcol(time_col).cast("timestamp"), F.current_timezone()))
    df = df.withWatermark(time_col, delay)
    if id_col:
        df = df.dropDuplicatesWithinWatermark([id_col])
    items = [
        F.struct(F.lit(i).alias("k"), as_text(qcol(c), field_type(stream_df, c)).alias("v"))
        for i, c in enumerate(by_element)
    ]
    rows = df.select(qcol(time_col).alias("_time"), F.explode(F.array(*items)).alias("_e"))
    values = rows.groupBy(F.window("_time", window).alias("w"), F.col("_e.k").alias("k"), F.col("_e.v").alias("v")).agg(
        F.count(F.lit(1)).alias("rows"))
    totals = values.groupBy(F.window(F.window_time("w"), window).alias("w"), "k").agg(
        F.sum("rows").alias("n"), F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("rows"))), F.lit(0)).alias("c"),
        F.count("v").alias("d"))
    made = {"uniqueness": ("d", "n"), "distinctness": ("d", "c"), "completeness": ("c", "n")}
    structs = []
    for i, (column, own) in enumerate(by_element.items()):
        for r in own:
            succ, total = made[r.rule.strip().lower()]
            slo = parse_slo(r.slo)
            structs.append(
                f"IF(k = {i}, named_struct('source', {str_lit(r.source)}, 'entity', {str_lit(r.entity)}, 'rule_applied_on', {str_lit(column)}, "
                f"'rule', {str_lit(r.rule)}, 'rule_name', {str_lit(r.rule_name)}, 'dimension', {str_lit(r.dimension)}, "
                f"'slo_op', {str_lit(slo[0] if slo else None)}, 'slo_value', CAST({slo[1] if slo else 'NULL'} AS DOUBLE), "
                f"'success_count', {succ}, 'failure_count', {total} - {succ}, 'count', {total}), NULL)")
    long = totals.selectExpr(
        "w.start AS window_start", "w.end AS window_end", f"explode(filter(array({', '.join(structs)}), x -> x IS NOT NULL)) AS r"
    ).select("window_start", "window_end", "r.*")
    pct = pct_half_up_sql("success_count", "count")
    status = " ".join(f"WHEN slo_op = '{op}' THEN ({pct}) {sym} slo_value"
                      for op, sym in (("gt", ">"), ("lt", "<"), ("eq", "="), ("ge", ">="), ("le", "<=")))
    shown = "CAST(to_utc_timestamp({0}, current_timezone()) AS TIMESTAMP_NTZ) AS {0}" if naive else "{0}"
    return long.selectExpr(
        shown.format("window_start"), shown.format("window_end"), "source", "entity", "rule_applied_on", "rule", "rule_name", "dimension", "success_count", "failure_count",
        "count", f"{pct} AS pass_percentage", f"CASE {status} END AS constraint_status")


def run_windows(result: DataFrame, path: str | None = None, checkpoint: str | None = None) -> WindowRun:
    """Run a window result over all available input (each micro-batch writes a folder of its own, so a retried one replaces
    its rows). Calling it again with the same ``path`` and ``checkpoint`` goes on where it stopped."""
    spark = result.sparkSession
    path = path or scratch_path(spark, "stream_windows")
    checkpoint = checkpoint or scratch_path(spark, "stream_checkpoint")
    spark.createDataFrame([], result.schema).write.mode("append").parquet(f"{path}/batch_id=-1")

    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={epoch_id}")

    query = (result.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    # the first operator of the plan meets every late row, later ones none of them
    late = sum(max((op.numRowsDroppedByWatermark for op in p.stateOperators), default=0) for p in query.recentProgress)
    return WindowRun(spark.read.schema(result.schema).parquet(path).select(*result.columns), late)
