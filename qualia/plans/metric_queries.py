"""Registered queries for quality metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualia.operators.metrics import (
    CountDistinct,
    Completeness,
    Compliance,
    Distinctness,
    Histogram,
    Maximum,
    MaxLength,
    Mean,
    Minimum,
    MinLength,
    Size,
    StandardDeviation,
    Sum,
    Uniqueness,
    metrics_from_config,
    run_metrics,
)
from qualia.plans.common import table


def documents_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels; unlabelled documents get null labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")


def orders_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose unspecified priority reads as null."""
    o = table(spark, sf_dir, "orders")
    return o.withColumn("o_orderpriority", F.expr("nullif(o_orderpriority, '4-NOT SPECIFIED')"))


def q_metric_size(spark, sf_dir):
    return run_metrics(documents_labels(spark, sf_dir), [Size()])


def q_metric_completeness(spark, sf_dir):
    df = documents_labels(spark, sf_dir)
    return run_metrics(df, [Completeness("quality"), Completeness("toxic"), Completeness("lang")])


def q_metric_completeness_where(spark, sf_dir):
    df = documents_labels(spark, sf_dir)
    return run_metrics(
        df,
        [
            Completeness("quality", where="lang = 'en'"),
            Completeness("toxic", where="source = 'src3'"),
            Size(where="lang = 'de'"),
        ],
    )


def q_metric_distinctness(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return run_metrics(df, [Distinctness("l_orderkey"), Distinctness("l_partkey"), Distinctness("l_returnflag")])


def q_metric_uniqueness(spark, sf_dir):
    df = orders_with_nulls(spark, sf_dir)
    return run_metrics(df, [Uniqueness("o_custkey"), Uniqueness("o_orderkey"), Uniqueness("o_orderpriority")])


def q_metric_uniqueness_multi(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return run_metrics(
        df,
        [
            Uniqueness(["l_orderkey", "l_linenumber"]),
            Distinctness(["l_orderkey", "l_linenumber"]),
            Uniqueness(["l_returnflag", "l_linestatus"]),
        ],
    )


def q_metric_count_distinct(spark, sf_dir):
    df = orders_with_nulls(spark, sf_dir)
    return run_metrics(df, [CountDistinct("o_custkey"), CountDistinct("o_orderstatus"), CountDistinct("o_orderpriority")])


def q_metric_compliance(spark, sf_dir):
    df = orders_with_nulls(spark, sf_dir)
    return run_metrics(
        df,
        [
            Compliance("priority_urgent_or_high", "o_orderpriority in ('1-URGENT', '2-HIGH')"),
            Compliance("big_order", "o_totalprice > 300000"),
            Compliance("big_open_order", "o_totalprice > 300000", where="o_orderstatus = 'O'"),
        ],
    )


def q_metric_lengths(spark, sf_dir):
    df = table(spark, sf_dir, "documents")
    return run_metrics(df, [MaxLength("text"), MinLength("text"), MaxLength("lang"), MinLength("source")])


def q_metric_numeric(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    out = run_metrics(
        df,
        [
            Mean("l_quantity"),
            Sum("l_quantity"),
            StandardDeviation("l_quantity"),
            Minimum("l_quantity"),
            Maximum("l_quantity"),
            Mean("l_linenumber"),
            StandardDeviation("l_linenumber"),
        ],
    )
    return out.withColumn("value", F.round("value", 6))


def q_metric_histogram(spark, sf_dir):
    df = table(spark, sf_dir, "events").withColumn("event_type", F.expr("nullif(event_type, 'error')"))
    return run_metrics(df, [Histogram("event_type"), Histogram("user_id", where="value > 50")])


CUSTOMER_METRIC_CONFIG = [
    {"rule_name": "completeness", "on_columns": ["c_custkey", "c_name", "c_mktsegment", "c_nationkey"]},
    {"rule_name": "distinctness", "on_columns": ["c_nationkey", "c_mktsegment"]},
    {"rule_name": "uniqueness", "on_columns": ["c_name", "c_custkey"]},
    {"rule_name": "max_length", "on_columns": ["c_name", "c_mktsegment"]},
    {"rule_name": "min_length", "on_columns": ["c_name", "c_acctbal"]},
]


def q_metrics_from_config(spark, sf_dir):
    df = table(spark, sf_dir, "customer").withColumn(
        "c_mktsegment", F.expr("nullif(c_mktsegment, 'HOUSEHOLD')")
    )
    out = metrics_from_config(df, CUSTOMER_METRIC_CONFIG)
    return out.select("entity", "instance", "name", "value", F.col("error").isNotNull().alias("failed"))


def q_metric_errors(spark, sf_dir):
    """Metrics that cannot be computed, reported beside those that can."""
    df = table(spark, sf_dir, "orders")
    wanted = [Size(), Completeness("o_comment_missing"), MaxLength("o_totalprice"), Uniqueness(["o_orderkey", "nowhere"]),
              Compliance("typo", "o_totalprize > 3"), Mean("o_totalprice", where="o_orderstatus = 'no such status'"), CountDistinct("o_orderstatus")]
    return run_metrics(df, wanted, on_error="report").select(
        "entity", "instance", "name", "value", F.col("error").isNotNull().alias("failed"))


QUERIES = {
    "metric_errors": q_metric_errors,
    "metric_size": q_metric_size,
    "metric_completeness": q_metric_completeness,
    "metric_completeness_where": q_metric_completeness_where,
    "metric_distinctness": q_metric_distinctness,
    "metric_uniqueness": q_metric_uniqueness,
    "metric_uniqueness_multi": q_metric_uniqueness_multi,
    "metric_count_distinct": q_metric_count_distinct,
    "metric_compliance": q_metric_compliance,
    "metric_lengths": q_metric_lengths,
    "metric_numeric": q_metric_numeric,
    "metric_histogram": q_metric_histogram,
    "metrics_from_config": q_metrics_from_config,
}
