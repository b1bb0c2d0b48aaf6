"""Registered queries (name -> builder(spark, sf_dir)) and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from qualia.plans import check_queries, metric_queries, misc_queries, oracle_misc, oracle_states, oracle_store, state_queries, store_queries, oracle_checks, oracle_metrics, oracle_profile, oracle_rules, profile_queries
from qualia.plans.rules_queries import (
    q_rule_aggregate_uniqueness,
    q_rule_documents_json,
    q_rule_metrics_lineitem,
    q_rule_metrics_orders,
    q_rule_packed_results,
    q_rule_row_results,
    q_stream_rule_metrics,
    q_stream_window_uniqueness,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rule_metrics_orders": q_rule_metrics_orders,
    "rule_metrics_lineitem": q_rule_metrics_lineitem,
    "rule_row_results": q_rule_row_results,
    "rule_packed_results": q_rule_packed_results,
    "rule_aggregate_uniqueness": q_rule_aggregate_uniqueness,
    "stream_rule_metrics": q_stream_rule_metrics,
    "stream_window_uniqueness": q_stream_window_uniqueness,
    "rule_documents_json": q_rule_documents_json,
    **metric_queries.QUERIES,
    **profile_queries.QUERIES,
    **check_queries.QUERIES,
    **misc_queries.QUERIES,
    **store_queries.QUERIES,
    **state_queries.QUERIES,
}

ORACLE: dict[str, str] = {
    "rule_metrics_orders": oracle_rules.rule_metrics_orders(),
    "rule_metrics_lineitem": oracle_rules.rule_metrics_lineitem(),
    "rule_row_results": oracle_rules.rule_row_results(),
    "rule_packed_results": oracle_rules.rule_row_results(),
    "rule_aggregate_uniqueness": oracle_rules.rule_aggregate_uniqueness(),
    "stream_rule_metrics": oracle_rules.stream_rule_metrics(),
    "stream_window_uniqueness": oracle_rules.STREAM_WINDOW_UNIQUENESS,
    "rule_documents_json": oracle_rules.rule_documents_json(),
    **oracle_metrics.ORACLE,
    **oracle_profile.ORACLE,
    **oracle_checks.ORACLE,
    **oracle_misc.ORACLE,
    **oracle_store.ORACLE,
    **oracle_states.ORACLE,
}
