"""DuckDB oracle SQL for the rule-validation queries.

Written independently of the Spark operators: each rule is one UNION ALL branch.
"""

from __future__ import annotations

import re


def _pct(s: str, n: str) -> str:
    return f"CASE WHEN {n} > 0 THEN (({s} * 20000 + {n}) // ({n} * 2)) / 100.0::DOUBLE END"


def _q(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def _status(pct: str, op, bound) -> str:
    return "CAST(NULL AS BOOLEAN)" if op is None else f"({pct}) {op} {bound}"


def row_rule_metric(table, source, entity, element, rule, name, dim, op, bound) -> str:
    pct = _pct("s", "n")
    return (
        f"SELECT {_q(source)} AS source, {_q(entity)} AS entity, {_q(element)} AS rule_applied_on, "
        f"{_q(rule)} AS rule, {_q(name)} AS rule_name, {_q(dim)} AS dimension, s AS success_count, "
        f"f AS failure_count, n AS count, {pct} AS pass_percentage, {_status(pct, op, bound)} AS constraint_status "
        f"FROM (SELECT count_if({rule}) AS s, count_if(NOT ({rule})) AS f, count(*) AS n FROM {table})"
    )


def agg_rule_metric(table, source, entity, element, kind, name, dim, op, bound) -> str:
    if kind == "uniqueness":
        succ, tot = f"count(DISTINCT {element})", "count(*)"
    elif kind == "distinctness":
        succ, tot = f"count(DISTINCT {element})", f"count({element})"
    else:
        succ, tot = f"count({element})", "count(*)"
    pct = _pct("s", "n")
    return (
        f"SELECT {_q(source)} AS source, {_q(entity)} AS entity, {_q(element)} AS rule_applied_on, "
        f"{_q(kind)} AS rule, {_q(name)} AS rule_name, {_q(dim)} AS dimension, s AS success_count, "
        f"n - s AS failure_count, n AS count, {pct} AS pass_percentage, ({pct}) {op} {bound} AS constraint_status "
        f"FROM (SELECT {succ} AS s, {tot} AS n FROM {table})"
    )


OPS = {None: None, "gt": ">", "lt": "<", "eq": "=", "ge": ">=", "le": "<="}

# (element, rule text, name, dimension, op, bound) of the rules that must run:
# the inactive rule and the rule on an element outside cde/kde are left out on purpose.
ORDERS_ROW_RULES = [
    ("o_totalprice", "o_totalprice > 0", "payable", "validity", "eq", 100),
    ("o_totalprice", "o_totalprice < 250000 or o_orderstatus = 'F'", "no_credit_review", "consistency", "ge", 80),
    ("o_custkey", "o_custkey % 3 <> 0", "regional_customer", "conformity", "lt", 70),
    ("o_orderpriority", "nullif(o_orderpriority, '4-NOT SPECIFIED') rlike '^[1-5]-'", "priority_ranked", "format", "gt", 99),
    ("o_orderstatus", "o_orderstatus = 'F'", "settled", "timeliness", None, None),
]

LINEITEM_ROW_RULES = [
    ("l_quantity", "l_quantity > 0", "quantity_positive", "validity", "eq", 100),
    ("l_quantity", "l_quantity <= 25", "quantity_small_order", "validity", "ge", 50),
    ("l_discount", "l_discount between 0.0 and 0.1", "discount_range", "validity", "gt", 99),
    ("l_shipdate", "l_shipdate < timestamp_ntz '1998-01-01 00:00:00'", "shipped_before_1998", "timeliness", "ge", 80),
    ("l_returnflag", "l_returnflag in ('R', 'A', 'N')", "returnflag_known", "conformity", "eq", 100),
    ("l_returnflag", "nullif(l_returnflag, 'N') is not null or l_linestatus = 'O'", "returnflag_matches_status",
     "consistency", "gt", 50),
]


def _duck(rule: str) -> str:
    rule = rule.replace("timestamp_ntz '", "TIMESTAMP '")
    return re.sub(r"(nullif\([^)]*\)) rlike ('[^']*')", r"regexp_matches(\1, \2)", rule)


def _row_parts(table: str, source: str, rules) -> list[str]:
    return [
        row_rule_metric(table, source, table, e, _duck(r), n, d, OPS[o], b).replace(f"{_q(_duck(r))} AS rule,", f"{_q(r)} AS rule,")
        for e, r, n, d, o, b in rules
    ]


def _filled() -> str:
    return agg_rule_metric("orders", "billing", "orders", "o_orderpriority", "completeness", "priority_filled", "completeness", ">", 75)


def rule_metrics_orders() -> str:
    repeat = agg_rule_metric("orders", "billing", "orders", "o_custkey", "distinctness", "repeat_customers", "distinctness", "<=", 50)
    return "\nUNION ALL\n".join([*_row_parts("orders", "billing", ORDERS_ROW_RULES), repeat, _filled()])


def rule_metrics_lineitem() -> str:
    parts = _row_parts("lineitem", "sales", LINEITEM_ROW_RULES)
    parts += [
        agg_rule_metric("lineitem", "sales", "lineitem", "l_orderkey", "uniqueness", "orderkey_uniqueness",
                        "uniqueness", ">", 90),
        agg_rule_metric("lineitem", "sales", "lineitem", "l_orderkey", "distinctness", "orderkey_distinctness",
                        "uniqueness", ">", 20),
        agg_rule_metric("lineitem", "sales", "lineitem", "l_partkey", "uniqueness", "partkey_uniqueness",
                        "uniqueness", "<", 10),
        agg_rule_metric("lineitem", "sales", "lineitem", "l_partkey", "completeness", "partkey_completeness",
                        "completeness", "=", 100),
    ]
    return "\nUNION ALL\n".join(parts)


def rule_aggregate_uniqueness() -> str:
    return "\nUNION ALL\n".join(
        [
            agg_rule_metric("lineitem", "sales", "lineitem", "l_orderkey", "uniqueness", "l_orderkey_uniqueness",
                            "uniqueness", ">", 90),
            agg_rule_metric("lineitem", "sales", "lineitem", "l_suppkey", "uniqueness", "l_suppkey_uniqueness",
                            "uniqueness", "<", 5),
            agg_rule_metric("orders", "sales", "orders", "o_custkey", "uniqueness", "o_custkey_uniqueness",
                            "uniqueness", ">", 90),
            agg_rule_metric("orders", "sales", "orders", "o_orderkey", "uniqueness", "o_orderkey_uniqueness",
                            "uniqueness", "=", 100),
        ]
    )


def rule_row_results() -> str:
    branches = []
    for e, r, n, d, _, _ in ORDERS_ROW_RULES:
        branches.append(
            f"SELECT o_orderkey, {_q(e)} AS rule_applied_on, 'billing' AS source, 'orders' AS entity, "
            f"{_q(r)} AS rule, {_q(n)} AS rule_name, {_q(d)} AS dimension, CAST({e} AS VARCHAR) AS value, "
            f"({_duck(r)}) AS result, TIMESTAMP '2024-01-01 00:00:00' AS run_date FROM orders"
        )
    return "\nUNION ALL\n".join(branches)


def stream_rule_metrics() -> str:
    rules = [r for r in ORDERS_ROW_RULES if r[0] != "o_custkey"]
    return "\nUNION ALL\n".join([*_row_parts("orders", "billing", rules), _filled()])


def rule_documents_json() -> str:
    pct = _pct("s", "n")
    named = (
        "SELECT seg, 'c_name' AS el, 'length(C_Name) > 0' AS rule, 'named' AS name, count_if(length(c_name) > 0) AS s, "
        "count(length(c_name)) - count_if(length(c_name) > 0) AS f, count(*) AS n FROM c GROUP BY seg"
    )
    balance = (
        "SELECT seg, 'c_acctbal' AS el, 'c_acctbal >= ' || lo AS rule, 'balance_' || seg AS name, count_if(c_acctbal >= lo) AS s, "
        "count(c_acctbal) - count_if(c_acctbal >= lo) AS f, count(*) AS n FROM c JOIN m USING (seg) GROUP BY seg, lo"
    )
    return (
        "WITH c AS (SELECT lower(c_mktsegment) AS seg, c_name, c_acctbal FROM customer), "
        "m AS (SELECT seg, CAST(floor(min(c_acctbal) / 2) AS BIGINT) AS lo FROM c GROUP BY seg) "
        "SELECT 'crm' AS source, seg AS entity, el AS rule_applied_on, rule, name AS rule_name, CAST(NULL AS VARCHAR) AS dimension, "
        f"s AS success_count, f AS failure_count, n AS count, {pct} AS pass_percentage, CAST(NULL AS BOOLEAN) AS constraint_status "
        f"FROM ({named} UNION ALL {balance})"
    )


STREAM_WINDOW_UNIQUENESS = """
WITH e AS (SELECT *, date_trunc('day', ts)::TIMESTAMP AS w, CASE WHEN event_type <> 'error' THEN value END AS v FROM events),
d AS (SELECT w, count(*) AS n, count(DISTINCT user_id) AS users, count(event_type) AS typed, count(DISTINCT event_type) AS types,
             count(v) AS valued
      FROM e GROUP BY w HAVING w + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)),
r AS (SELECT w, 'user_id' AS rule_applied_on, 'uniqueness' AS rule, 'users_per_event' AS rule_name, 'uniqueness' AS dimension, users AS s, n AS t FROM d
      UNION ALL SELECT w, 'event_type', 'distinctness', 'types_per_event', 'uniqueness', types, typed FROM d
      UNION ALL SELECT w, 'value', 'completeness', 'valued', 'completeness', valued, n FROM d),
p AS (SELECT *, CASE WHEN t > 0 THEN ((20000 * s + t) // (2 * t)) / 100.0 END AS pct FROM r)
SELECT w AS window_start, w + INTERVAL 1 DAY AS window_end, 'web' AS source, 'events' AS entity, rule_applied_on, rule, rule_name, dimension,
       s AS success_count, t - s AS failure_count, t AS count, CAST(pct AS DOUBLE) AS pass_percentage,
       CASE rule_name WHEN 'users_per_event' THEN pct >= 40 WHEN 'types_per_event' THEN pct < 1.5 END AS constraint_status
FROM p
"""
