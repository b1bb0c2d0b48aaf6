"""Registered queries for rule validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualia.operators.by_entity import rule_metrics_by_entity
from qualia.operators.packed import packed_row_results
from qualia.operators.validate import row_results, rule_metrics
from qualia.plans.common import RUN_TS, table
from qualia.session import scratch_path
from qualia.sources.rules import read_rule_documents, rules_of, rules_table, select_rules

def _rule(name: str, rule: str, dimension: str, slo: str | None = None, **more) -> dict:
    return {"rule_name": name, "rule": rule, "dimension": dimension, "slo": slo, "is_active": 1, **more}


# Billing's rules for orders: one element is listed nowhere and one rule is switched off, so neither runs.
ORDERS_DOC = {
    "source": "billing",
    "entity": "orders",
    "cde": ["o_totalprice", "o_custkey"],
    "kde": ["o_orderpriority", "o_orderstatus"],
    "rules_run_on": ["cde", "kde"],
    "primary_key": "o_orderkey",
    "single_column_validation_rules": {
        "o_totalprice": [
            _rule("payable", "o_totalprice > 0", "validity", "eq(100)"),
            _rule("no_credit_review", "o_totalprice < 250000 or o_orderstatus = 'F'", "consistency", "ge(80)"),
        ],
        "o_custkey": [
            _rule("regional_customer", "o_custkey % 3 <> 0", "conformity", "lt(70)"),
            _rule("repeat_customers", "distinctness", "distinctness", "le(50)", rule_type="aggregate"),
            _rule("customer_off", "o_custkey < 0", "validity", "gt(1)") | {"is_active": 0},
        ],
        "o_orderpriority": [
            _rule("priority_ranked", "nullif(o_orderpriority, '4-NOT SPECIFIED') rlike '^[1-5]-'", "format", "gt(99)"),
            _rule("priority_filled", "completeness", "completeness", "gt(75)", rule_type="aggregate"),
        ],
        "o_orderstatus": [_rule("settled", "o_orderstatus = 'F'", "timeliness")],
        "o_orderkey": [_rule("unlisted_element", "o_orderkey > 0", "validity", "gt(90)")],
    },
}

# What a stream can hold in counters: the same entity without distinct counts.
ORDERS_STREAM_DOC = ORDERS_DOC | {
    "cde": ["o_totalprice"],
    "single_column_validation_rules": {
        k: v for k, v in ORDERS_DOC["single_column_validation_rules"].items() if k != "o_custkey"
    },
}

LINEITEM_DOC = {
    "source": "sales",
    "entity": "lineitem",
    "cde": ["l_quantity", "l_discount", "l_shipdate", "l_orderkey"],
    "kde": ["l_returnflag", "l_linestatus", "l_partkey"],
    "rules_run_on": ["cde", "kde"],
    "single_column_validation_rules": {
        "l_quantity": [
            {
                "rule_name": "quantity_positive",
                "rule": "l_quantity > 0",
                "dimension": "validity",
                "is_active": 1,
                "slo": "eq(100)",
            },
            {
                "rule_name": "quantity_small_order",
                "rule": "l_quantity <= 25",
                "dimension": "validity",
                "is_active": 1,
                "slo": "ge(50)",
            },
        ],
        "l_discount": [
            {
                "rule_name": "discount_range",
                "rule": "l_discount between 0.0 and 0.1",
                "dimension": "validity",
                "is_active": 1,
                "slo": "gt(99)",
            }
        ],
        "l_shipdate": [
            {
                "rule_name": "shipped_before_1998",
                "rule": "l_shipdate < timestamp_ntz '1998-01-01 00:00:00'",
                "dimension": "timeliness",
                "is_active": 1,
                "slo": "ge(80)",
            }
        ],
        "l_returnflag": [
            {
                "rule_name": "returnflag_known",
                "rule": "l_returnflag in ('R', 'A', 'N')",
                "dimension": "conformity",
                "is_active": 1,
                "slo": "eq(100)",
            },
            {
                "rule_name": "returnflag_matches_status",
                "rule": "nullif(l_returnflag, 'N') is not null or l_linestatus = 'O'",
                "dimension": "consistency",
                "is_active": 1,
                "slo": "gt(50)",
            },
        ],
        "l_orderkey": [
            {
                "rule_name": "orderkey_uniqueness",
                "rule": "uniqueness",
                "rule_type": "aggregate",
                "dimension": "uniqueness",
                "is_active": 1,
                "slo": "gt(90)",
            },
            {
                "rule_name": "orderkey_distinctness",
                "rule": "distinctness",
                "rule_type": "aggregate",
                "dimension": "uniqueness",
                "is_active": 1,
                "slo": "gt(20)",
            },
        ],
        "l_partkey": [
            {
                "rule_name": "partkey_uniqueness",
                "rule": "uniqueness",
                "rule_type": "aggregate",
                "dimension": "uniqueness",
                "is_active": 1,
                "slo": "lt(10)",
            },
            {
                "rule_name": "partkey_completeness",
                "rule": "completeness",
                "rule_type": "aggregate",
                "dimension": "completeness",
                "is_active": 1,
                "slo": "eq(100)",
            },
        ],
    },
}


def q_rule_metrics_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_metrics(table(spark, sf_dir, "orders"), rules_of(spark, [ORDERS_DOC]))


def q_rule_metrics_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_metrics(table(spark, sf_dir, "lineitem"), rules_of(spark, [LINEITEM_DOC]))


def q_rule_row_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rules_of(spark, [ORDERS_DOC])
    return row_results(table(spark, sf_dir, "orders"), rules, pass_through=["o_orderkey"], run_ts=RUN_TS)


def q_rule_aggregate_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregate rules alone, on lineitem and orders keys, stacked by name."""
    rules = [
        {"element": "l_orderkey", "rule": "uniqueness", "rule_name": "l_orderkey_uniqueness",
         "rule_type": "aggregate", "dimension": "uniqueness", "slo": "gt(90)",
         "source": "sales", "entity": "lineitem"},
        {"element": "l_suppkey", "rule": "uniqueness", "rule_name": "l_suppkey_uniqueness",
         "rule_type": "aggregate", "dimension": "uniqueness", "slo": "lt(5)",
         "source": "sales", "entity": "lineitem"},
    ]
    orders_rules = [
        {"element": "o_custkey", "rule": "uniqueness", "rule_name": "o_custkey_uniqueness",
         "rule_type": "aggregate", "dimension": "uniqueness", "slo": "gt(90)",
         "source": "sales", "entity": "orders"},
        {"element": "o_orderkey", "rule": "uniqueness", "rule_name": "o_orderkey_uniqueness",
         "rule_type": "aggregate", "dimension": "uniqueness", "slo": "eq(100)",
         "source": "sales", "entity": "orders"},
    ]
    return rule_metrics(table(spark, sf_dir, "lineitem"), rules).unionByName(
        rule_metrics(table(spark, sf_dir, "orders"), orders_rules)
    )


def q_stream_rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running rule metrics over orders read as a file stream, run to the end of the input."""
    from qualia.streaming.validate import read_stream, run_available, stream_rule_metrics

    schema = table(spark, sf_dir, "orders").schema
    stream = read_stream(spark, sf_dir, schema, pattern="orders.parquet")
    return run_available(stream_rule_metrics(stream, rules_of(spark, [ORDERS_STREAM_DOC])))


EVENT_WINDOW_RULES = [
    {"element": "user_id", "rule": "uniqueness", "rule_name": "users_per_event", "rule_type": "aggregate", "dimension": "uniqueness",
     "slo": "ge(40)", "source": "web", "entity": "events"},
    {"element": "event_type", "rule": "distinctness", "rule_name": "types_per_event", "rule_type": "aggregate",
     "dimension": "uniqueness", "slo": "lt(1.5)", "source": "web", "entity": "events"},
    {"element": "value", "rule": "completeness", "rule_name": "valued", "rule_type": "aggregate", "dimension": "completeness",
     "source": "web", "entity": "events"},
]


def q_stream_window_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct rules over events as a stream, day by day: every day that the watermark has closed."""
    from qualia.streaming.distinct import run_windows, window_rule_metrics
    from qualia.streaming.validate import read_stream

    stream = read_stream(spark, sf_dir, table(spark, sf_dir, "events").schema, pattern="events.parquet")
    stream = stream.withColumn("value", F.expr("CASE WHEN event_type <> 'error' THEN value END"))
    return run_windows(window_rule_metrics(stream, EVENT_WINDOW_RULES, "ts", "1 day", "1 hour", id_col="event_id")).results


def q_rule_documents_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule documents end to end: one document per customer segment is written as JSON, read back,
    flattened and selected; the documents' rules then run on the customers of each segment."""
    customer = table(spark, sf_dir, "customer")
    rule = "named_struct('rule_name', concat('balance_', lower(c_mktsegment)), 'rule', concat('c_acctbal >= ', cast(lo as string)))"
    docs = customer.groupBy("c_mktsegment").agg(F.floor(F.min("c_acctbal") / 2).alias("lo")).selectExpr(
        "'crm' AS source",
        f"""array(named_struct('entity', lower(c_mktsegment), 'cde', array('c_acctbal', 'c_name'), 'kde', array('c_nationkey'),
            'run_rules_on', array('cde'),
            'validation_rules', named_struct(
                'cde', array({rule}, named_struct('rule_name', 'named', 'rule', 'length(C_Name) > 0')),
                'kde', array(named_struct('rule_name', 'never_run', 'rule', 'c_nationkey < 0'))))) AS entities""")
    path = scratch_path(spark, "rule-documents")
    docs.write.json(path)
    rules = select_rules(rules_table(read_rule_documents(spark, path, multi_line=False)))
    return rule_metrics_by_entity(customer, rules, "lower(c_mktsegment)")


def q_rule_packed_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row results kept as one row per order (written and read again), unpacked."""
    packed = packed_row_results(table(spark, sf_dir, "orders"), rules_of(spark, [ORDERS_DOC]), pass_through=["o_orderkey"])
    path = scratch_path(spark, "packed-results")
    packed.rows.write.parquet(path)
    return packed.unpack(spark.read.schema(packed.rows.schema).parquet(path), run_ts=RUN_TS)
