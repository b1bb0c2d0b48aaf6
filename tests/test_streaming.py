import pytest

from qualia.operators.validate import rule_metrics
from qualia.streaming.validate import read_stream, run_available, stream_row_results, stream_rule_metrics

RULES = [
    {"element": "o_orderstatus", "rule": "o_orderstatus in ('F', 'O')", "rule_name": "status", "slo": "ge(50)"},
    {"element": "o_totalprice", "rule": "o_totalprice > 100000", "rule_name": "big", "slo": "gt(10)"},
    {"element": "o_orderkey", "rule": "completeness", "rule_type": "aggregate", "rule_name": "key_complete"},
]


def test_streaming_metrics_equal_batch(spark, tmp_path):
    src = tmp_path / "in"
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    orders.repartition(4).write.parquet(str(src))  # several files -> several micro-batches
    stream = read_stream(spark, str(src), orders.schema, max_files_per_trigger=1)
    got = run_available(stream_rule_metrics(stream, RULES), str(tmp_path / "out"), str(tmp_path / "ck"))
    want = rule_metrics(orders, RULES)
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())


def test_streaming_row_results_append(spark, tmp_path):
    src = tmp_path / "in"
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    orders.write.parquet(str(src))
    stream = read_stream(spark, str(src), orders.schema)
    got = run_available(stream_row_results(stream, RULES[:2], pass_through=["o_orderkey"], run_ts="2024-01-01"),
                        str(tmp_path / "out"), str(tmp_path / "ck"), output_mode="append")
    assert got.count() == 2 * orders.count()


def test_streaming_refuses_distinct_rules(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    stream = read_stream(spark, "/root/testdata/sf0.001", orders.schema, pattern="orders.parquet")
    with pytest.raises(ValueError, match="distinct"):
        stream_rule_metrics(stream, [{"element": "o_orderkey", "rule": "uniqueness", "rule_type": "aggregate",
                                      "rule_name": "u"}])


def test_empty_stream_and_modes(spark, tmp_path):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    empty = tmp_path / "empty"
    empty.mkdir()
    stream = read_stream(spark, str(empty), orders.schema)
    got = run_available(stream_rule_metrics(stream, RULES[:2]), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert got.count() == 0
    with pytest.raises(ValueError, match="update"):
        run_available(stream_rule_metrics(stream, RULES[:2]), output_mode="update")
