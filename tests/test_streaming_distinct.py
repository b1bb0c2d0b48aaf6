"""Distinct rules over event-time windows of a stream."""

import datetime as dt

import pytest

from qualia.streaming.distinct import run_windows, window_rule_metrics
from qualia.streaming.validate import read_stream

SCHEMA = "id long, ts timestamp_ntz, who string, score double"
RULES = [
    {"element": "WHO", "rule": "uniqueness", "rule_name": "u", "slo": "ge(50)", "rule_type": "aggregate"},
    {"element": "who", "rule": "distinctness", "rule_name": "d", "rule_type": "aggregate"},
    {"element": "score", "rule": "completeness", "rule_name": "c", "slo": "eq(100)", "rule_type": "aggregate"},
]


def at(minute):
    return dt.datetime(2024, 5, 1, 22) + dt.timedelta(minutes=minute)


def send(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def counts(run):
    return {(r.window_start, r.rule_name): (r.success_count, r.failure_count, r["count"], r.pass_percentage, r.constraint_status)
            for r in run.results.collect()}


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
def test_windows_close_with_the_watermark_and_late_rows_are_counted(spark, tmp_path, zone):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        schema = spark.createDataFrame([], SCHEMA).schema

        def run():
            stream = read_stream(spark, source, schema)
            return run_windows(window_rule_metrics(stream, RULES, "ts", "1 hour", "10 minutes", id_col="id"), path, checkpoint)

        # hour 22: a, a, null and b; hour 23: c; nothing after 23:40 is known yet, so hour 22 is closed
        send(spark, source, [(1, at(0), "a", 1.0), (2, at(20), "a", None), (3, at(59), None, 2.0), (4, at(59), "b", 0.0), (5, at(100), "c", 1.0)])
        first = run()
        assert first.late_rows == 0
        assert counts(first) == {
            (at(0), "u"): (2, 2, 4, 50.0, True), (at(0), "d"): (2, 1, 3, 66.67, None), (at(0), "c"): (3, 1, 4, 75.0, False)}
        # two rows come too late, one twice, one row of the open hour is in time; then hour 0 starts far enough on
        send(spark, source, [(6, at(5), "z", 1.0), (7, at(58), "y", 1.0), (8, at(95), "c", 1.0), (8, at(95), "c", 1.0), (9, at(200), "q", 1.0)])
        second = run()
        assert second.late_rows == 2
        got = counts(second)
        assert got.pop((at(60), "u")) == (1, 1, 2, 50.0, True)
        assert got.pop((at(60), "d")) == (1, 1, 2, 50.0, None) and got.pop((at(60), "c")) == (2, 0, 2, 100.0, True)
        assert got == counts(first)  # closed windows stay as they were
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_zoned_times_and_no_ids(spark, tmp_path):
    source = str(tmp_path / "in")
    df = spark.createDataFrame([(at(0), "a"), (at(1), "b"), (at(2), "a"), (at(300), "x")], "ts timestamp, who string")
    df.write.parquet(source)
    rules = [{"element": "who", "rule": "uniqueness", "rule_name": "u"}]
    run = run_windows(window_rule_metrics(read_stream(spark, source, df.schema), rules, "ts", "1 hour", "1 minute"))
    assert [(r.window_start, r.success_count, r["count"]) for r in run.results.collect()] == [(at(0), 2, 3)]


def test_state_is_bounded_by_the_watermark(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = spark.createDataFrame([], SCHEMA).schema
    for day in range(3):
        send(spark, source, [(100 * day + i, at(1440 * day + i), f"w{i}", 1.0) for i in range(100)])
        result = window_rule_metrics(read_stream(spark, source, schema), RULES, "ts", "1 hour", "10 minutes")
        query = (result.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).start())
        query.awaitTermination()
        kept = max(op.numRowsTotal for op in query.lastProgress.stateOperators)
    assert kept <= 2 * 100  # one day's open windows, not three days' values


def test_other_rules_and_empty_input(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    source = str(tmp_path / "in")
    send(spark, source, [])
    stream = read_stream(spark, source, schema)
    with pytest.raises(ValueError, match="windows answer"):
        window_rule_metrics(stream, [{"element": "who", "rule": "hasSize", "rule_name": "s"}], "ts", "1 hour", "1 minute")
    run = run_windows(window_rule_metrics(stream, RULES, "ts", "1 hour", "1 minute"))
    assert (run.late_rows, run.results.count()) == (0, 0)
