"""Mergeable metric states: any split of a table gives the metrics of the whole."""

import math
import random

import pytest
from pyspark.sql import functions as F

from qualia.operators import metric_states as states_module
from qualia.operators.metric_states import (
    ApproxQuantile,
    compact_states,
    merge_states,
    metric_states,
    metrics_from_states,
    save_states,
    stored_states,
)
from qualia.operators.metrics import (
    ApproxCountDistinct,
    Completeness,
    Compliance,
    CountDistinct,
    Distinctness,
    Histogram,
    Maximum,
    MaxLength,
    Mean,
    MetricError,
    Minimum,
    MinLength,
    Size,
    StandardDeviation,
    Sum,
    Uniqueness,
    run_metrics,
)

SCHEMA = "id long, part int, name string, score double"
EXACT = [
    Size(), Size(where="score > 0"), Completeness("name"), Compliance("long", "length(name) > 1", where="score > 0"), MaxLength("name"),
    MinLength("name"), Sum("score"), Mean("score"), StandardDeviation("score"), Minimum("score"), Maximum("score"), Mean("id"),
    Distinctness("name"), Uniqueness(["name", "part"]), CountDistinct("id"), Uniqueness("score", where="part > 1"), Histogram("name"),
]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    # a large common offset: differences of sums of squares would lose the deviation
    return [(i % 70, rng.randrange(5), rng.choice([None, "a", "bb", "ccc", ""]), rng.choice([None, 1e9 + rng.random(), -2.5, 0.0, -0.0]))
            for i in range(400)]


def values(df):
    return {(r.entity, r.instance, r.name): r.value for r in df.collect()}


def close(a, b):
    if a is None or b is None:
        return a is b
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)


@pytest.fixture(scope="module")
def whole(spark, rows):
    return values(run_metrics(spark.createDataFrame(rows, SCHEMA), EXACT))


@pytest.mark.parametrize("cuts", [[0], [0, 2, 4]])
def test_states_of_parts_are_the_metrics_of_the_whole(spark, rows, whole, tmp_path, cuts):
    df = spark.createDataFrame(rows, SCHEMA)
    path, edges = str(tmp_path / "states"), [*cuts, 99]
    for lo, hi in zip(edges, edges[1:]):
        save_states(metric_states(df.where(f"part >= {lo} AND part < {hi}"), EXACT, f"p{lo}"), path)
    save_states(metric_states(df.where("part > 99"), EXACT, "empty"), path)
    states = stored_states(spark, path)
    found = values(metrics_from_states(states, EXACT, df.schema))
    assert found.keys() == whole.keys()
    assert [k for k in whole if not close(found[k], whole[k])] == []
    # merging merged states changes nothing
    save_states(merge_states(states.where("part = 'p0'"), part="x"), str(tmp_path / "merged"))
    save_states(merge_states(states.where("part <> 'p0'"), part="y"), str(tmp_path / "merged"))
    again = values(metrics_from_states(stored_states(spark, str(tmp_path / "merged")), EXACT, df.schema))
    assert [k for k in whole if not close(again[k], whole[k])] == []


def test_metrics_of_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    save_states(metric_states(df, EXACT, "none"), str(tmp_path / "states"))
    found = values(metrics_from_states(stored_states(spark, str(tmp_path / "states")), EXACT, df.schema))
    whole = values(run_metrics(df, EXACT))
    assert found == whole


def test_a_part_sent_again_counts_once_and_parts_compact(spark, rows, whole, tmp_path):
    df = spark.createDataFrame(rows, SCHEMA)
    path, target = str(tmp_path / "states"), str(tmp_path / "compact")
    for rest in (0, 1, 0):
        save_states(metric_states(df.where(f"part % 2 = {rest}"), EXACT, f"day={rest}/x y"), path)
    found = values(metrics_from_states(stored_states(spark, path), EXACT, df.schema))
    assert [k for k in whole if not close(found[k], whole[k])] == []
    compact_states(spark, path, target, "all")
    assert stored_states(spark, target).select("part").distinct().count() == 1
    found = values(metrics_from_states(stored_states(spark, target), EXACT, df.schema))
    assert [k for k in whole if not close(found[k], whole[k])] == []


def test_new_metrics_read_only_states(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, SCHEMA)
    source, path = str(tmp_path / "source"), str(tmp_path / "states")
    df.write.parquet(source)
    save_states(metric_states(spark.read.parquet(source), EXACT, "a"), path)
    plan = metrics_from_states(stored_states(spark, path), EXACT, df.schema)._jdf.queryExecution().toString()
    assert source not in plan and path in plan


def test_merged_sketches_stay_within_their_bounds(spark):
    df = spark.range(0, 60_000).selectExpr("id % 30000 AS k", "cast(id as double) AS v")
    wanted = [ApproxCountDistinct("k"), ApproxQuantile("v", 0.25), ApproxQuantile("v", 0.9)]
    parts = [metric_states(df.where(f"v % 2 = {i}"), wanted, str(i)) for i in range(2)]
    found = values(metrics_from_states(parts[0].unionByName(parts[1]), wanted, df.schema))
    assert abs(found["Column", "k", "ApproxCountDistinct"] - 30000) < 0.05 * 30000
    assert abs(found["Column", "v", "ApproxQuantile-0.25"] - 15000) < 0.02 * 60000
    assert abs(found["Column", "v", "ApproxQuantile-0.9"] - 54000) < 0.02 * 60000
    direct = values(run_metrics(df, wanted))
    assert abs(direct["Column", "v", "ApproxQuantile-0.9"] - 54000) < 0.02 * 60000


def test_wrong_metrics_and_missing_states_are_told(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(MetricError, match="nowhere"):
        metric_states(df, [Completeness("nowhere")], "p")
    with pytest.raises(MetricError, match="string column"):
        metric_states(df, [MaxLength("score")], "p")
    states = metric_states(df, [Size()], "p")
    with pytest.raises(ValueError, match="no such states"):
        metrics_from_states(states, [Mean("score")], df.schema)


def test_key_counts_of_a_part_are_in_several_files(spark, tmp_path):
    df = spark.range(0, 40_000).selectExpr("id AS k")
    path = str(tmp_path / "states")
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small parts are put together
    try:
        save_states(metric_states(df, [Uniqueness("k")], "a"), path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    rows = [r["count"] for r in stored_states(spark, path).groupBy(F.input_file_name()).count().collect()]
    assert sum(rows) == 40_000 and max(rows) < 20_000


def test_stored_key_counts_are_added_in_tasks_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(states_module, "_ROWS_A_TASK", 100)
    df = spark.range(0, 1000).selectExpr("id AS k")
    path = str(tmp_path / "states")
    for part, rows in (("a", df), ("b", df.where("k < 500"))):
        save_states(metric_states(rows, [Uniqueness("k")], part), path)
    found = metrics_from_states(stored_states(spark, path), [Uniqueness("k")], df.schema)
    assert [round(r.value, 6) for r in found.collect()] == [round(500 / 1500, 6)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    # 1500 rows, dealt out before they are added up
    assert ", 16), REPARTITION_BY_NUM" in plan
