"""Registered queries for metrics from stored states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualia.operators.metric_states import ApproxQuantile, metric_states, metrics_from_states, save_states, stored_states
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
    Minimum,
    Size,
    StandardDeviation,
    Sum,
    Uniqueness,
)
from qualia.plans.common import table
from qualia.session import scratch_path

LINEITEM_METRICS = [
    Size(), Size(where="l_returnflag = 'R'"), Completeness("l_shipmode_seen"), Compliance("big", "l_quantity > 25"),
    Compliance("big_returned", "l_quantity > 25", where="l_returnflag = 'R'"), Sum("l_quantity"), Mean("l_extendedprice"),
    StandardDeviation("l_extendedprice"), Minimum("l_discount"), Maximum("l_tax"), MaxLength("l_shipmode_seen"),
    Distinctness("l_partkey"), Uniqueness("l_orderkey"), CountDistinct("l_suppkey"), Uniqueness(["l_orderkey", "l_linenumber"]),
    Histogram("l_shipmode_seen"),
]


def lineitem_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem with a text column that holds nulls."""
    return table(spark, sf_dir, "lineitem").withColumn("l_shipmode_seen", F.expr("nullif(l_linestatus, 'F')"))


def lineitem_slices(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Lineitem by year of shipment, as batches arrive: three slices and a last one that is sent again."""
    df = lineitem_flagged(spark, sf_dir)
    year = F.year("l_shipdate")
    return {"to_1996": df.where(year <= 1996), "to_1998": df.where((year > 1996) & (year <= 1998)), "later": df.where(year > 1998)}


def stored_lineitem_states(spark: SparkSession, sf_dir: str, analyzers, name: str) -> str:
    path = scratch_path(spark, name)
    for part, rows in lineitem_slices(spark, sf_dir).items():
        save_states(metric_states(rows, analyzers, part), path)
    return path


def q_metric_states_lineitem(spark, sf_dir):
    """Every metric of lineitem from the stored states of its slices; one slice is computed twice and counts once."""
    path = stored_lineitem_states(spark, sf_dir, LINEITEM_METRICS, "metric-states")
    again = lineitem_slices(spark, sf_dir)["later"]
    save_states(metric_states(again, LINEITEM_METRICS, "later"), path)
    out = metrics_from_states(stored_states(spark, path), LINEITEM_METRICS, lineitem_flagged(spark, sf_dir).schema)
    return out.withColumn("value", F.round("value", 6))


def q_metric_states_some(spark, sf_dir):
    """Metrics of two of three slices: the rows they cover are never read again."""
    wanted = [Size(), Mean("l_quantity"), StandardDeviation("l_quantity"), CountDistinct("l_partkey"), Completeness("l_shipmode_seen")]
    path = stored_lineitem_states(spark, sf_dir, wanted, "metric-states")
    some = stored_states(spark, path, ["to_1996", "later"])
    return metrics_from_states(some, wanted, lineitem_flagged(spark, sf_dir).schema).withColumn("value", F.round("value", 6))


def q_metric_states_sketches(spark, sf_dir):
    """Bound test of merged sketches: distinct counts within 5 %, quantiles within 2 % of rank."""
    columns = ["l_orderkey", "l_partkey", "l_suppkey"]
    sketches = [*(ApproxCountDistinct(c) for c in columns), ApproxQuantile("l_extendedprice", 0.5), ApproxQuantile("l_extendedprice", 0.9)]
    path = stored_lineitem_states(spark, sf_dir, sketches, "metric-sketches")
    df = lineitem_flagged(spark, sf_dir)
    found = metrics_from_states(stored_states(spark, path), sketches, df.schema)
    exact = df.agg(*[F.count_distinct(c).cast("double").alias(c) for c in columns])
    counts = exact.select(F.inline(F.array(*[F.struct(F.lit(c).alias("instance"), F.col(c).alias("exact")) for c in columns])))
    near = found.where("name = 'ApproxCountDistinct'").join(F.broadcast(counts), "instance").select(
        "instance", "name", (F.abs(F.col("value") - F.col("exact")) <= 0.05 * F.col("exact")).alias("within_bound"))
    quantiles = found.where("name LIKE 'ApproxQuantile%'").withColumn("q", F.regexp_extract("name", r"-(.*)$", 1).cast("double"))
    # ranks of the two found values
    ranks = df.select("l_extendedprice").join(F.broadcast(quantiles.select("name", "value")), F.col("l_extendedprice") <= F.col("value"))
    ranks = ranks.groupBy("name").agg(F.count(F.lit(1)).alias("below"))
    size = df.agg(F.count(F.lit(1)).alias("rows"))
    near_rank = quantiles.join(ranks, "name").join(F.broadcast(size), F.lit(True)).select(
        "instance", "name", (F.abs(F.col("below") / F.col("rows") - F.col("q")) <= 0.02).alias("within_bound"))
    return near.unionByName(near_rank)


QUERIES = {
    "metric_states_lineitem": q_metric_states_lineitem,
    "metric_states_some": q_metric_states_some,
    "metric_states_sketches": q_metric_states_sketches,
}
