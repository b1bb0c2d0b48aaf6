"""DuckDB oracle SQL for the check queries."""

ON = ("(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
      "nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority FROM orders)")
CN = "(SELECT c_custkey, c_name, c_acctbal, nullif(c_mktsegment, 'HOUSEHOLD') AS c_mktsegment FROM customer)"


def _uniq(keys, src):
    nn = " OR ".join(f"{k} IS NOT NULL" for k in keys.split(","))
    return (f"(SELECT CAST(count_if(nn AND n = 1) AS DOUBLE) / CAST(sum(CASE WHEN nn THEN n END) AS DOUBLE) "
            f"FROM (SELECT count(*) AS n, ({nn}) AS nn FROM {src} GROUP BY {keys}))")


def _suite(metrics_sql, src, constraints, tags=""):
    """constraints: (check, level, constraint text, metric column, assertion sql on v, hint, integral)."""
    rows = []
    for i, (check, level, text, metric, assertion, hint, integral) in enumerate(constraints):
        v = f"m.{metric}"
        ok = f"coalesce(({assertion.format(v=v)}), FALSE)"
        shown = f"CAST(CAST({v} AS BIGINT) AS VARCHAR)" if integral else f"CAST({v} AS VARCHAR)"
        msg = f"'Value: ' || coalesce({shown}, 'null') || ' does not meet the constraint requirement!'"
        if hint:
            msg += f" || ' {hint}'"
        t = text.replace("'", "''")
        rows.append(
            f"SELECT {i} AS i, '{check}' AS \"check\", '{level}' AS check_level, '{t}' AS \"constraint\", "
            f"CASE WHEN {ok} THEN 'Success' ELSE 'Failure' END AS constraint_status, "
            f"CASE WHEN {ok} THEN '' ELSE {msg} END AS constraint_message FROM m"
        )
    body = "\nUNION ALL\n".join(rows)
    return (
        f"WITH m AS ({metrics_sql}), c AS ({body}) "
        f'SELECT "check", check_level'
        f", CASE WHEN bool_and(constraint_status = 'Success') OVER (PARTITION BY \"check\") "
        f"THEN 'Success' ELSE check_level END AS check_status, \"constraint\", constraint_status, constraint_message{tags} "
        f"FROM c"
    )


ORDERS_METRICS = (
    "SELECT CAST(count(*) AS DOUBLE) AS size, "
    "CAST(count_if(coalesce(o_totalprice, 0.0) >= 0) AS DOUBLE) / count(*) AS nonneg, "
    "CAST(count_if(o_orderstatus <> 'F' AND o_totalprice < 480000) AS DOUBLE) / count_if(o_orderstatus <> 'F') AS credit, "
    "CAST(count(DISTINCT o_orderstatus) AS DOUBLE) AS statuses, "
    f"(SELECT CAST(count(*) AS DOUBLE) / sum(n) FROM (SELECT count(*) AS n FROM {ON} WHERE o_custkey IS NOT NULL GROUP BY o_custkey)) AS variety, "
    "CAST(count_if(o_orderpriority IS NOT NULL AND o_totalprice > 300000) AS DOUBLE) / count_if(o_totalprice > 300000) AS prio, "
    f"{_uniq('o_orderkey,o_custkey', ON)} AS uniq FROM {ON}"
)

A, C = "Order amounts", "Order customers"
ORDERS_CONSTRAINTS = [
    (C, "Error", "DistinctnessConstraint(Distinctness(List(o_custkey),None))", "variety", "{v} < 0.25", "customers should come back", False),
    (C, "Error", "CompletenessConstraint(Completeness(o_orderpriority,Some(o_totalprice > 300000)))", "prio", "{v} >= 0.99", None, False),
    (C, "Error", "UniquenessConstraint(Uniqueness(List(o_orderkey, o_custkey),None))", "uniq", "{v} = 1.0", None, False),
    (C, "Error", "SizeConstraint(Size(None))", "size", "{v} < 1000", None, True),
    (A, "Warning", "ComplianceConstraint(Compliance(o_totalprice is non-negative,COALESCE(`o_totalprice`, 0.0) >= 0,None))",
     "nonneg", "{v} = 1.0", None, False),
    (A, "Warning", "ComplianceConstraint(Compliance(within_credit,o_totalprice < 480000,Some(o_orderstatus <> 'F')))",
     "credit", "{v} > 0.9999", "ask credit control", False),
    (A, "Warning", "CountDistinctConstraint(CountDistinct(List(o_orderstatus),None))", "statuses", "{v} = 3", None, True),
]

CUSTOMER_METRICS = (
    "SELECT CAST(count(*) AS DOUBLE) AS size, "
    "CAST(count(c_name) AS DOUBLE) / count(*) AS compl_name, "
    "CAST(count(c_custkey) AS DOUBLE) / count(*) AS compl_key, "
    "CAST(count(c_mktsegment) AS DOUBLE) / count(*) AS compl_seg, "
    "CAST(count_if(c_acctbal >= 0) AS DOUBLE) / count(*) AS nonneg, "
    "CAST(count_if(c_mktsegment IS NULL OR c_mktsegment IN "
    "('AUTOMOBILE','BUILDING','FURNITURE','MACHINERY')) AS DOUBLE) / count(*) AS in_seg, "
    f"{_uniq('c_custkey', CN)} AS uniq_key, {_uniq('c_custkey,c_name', CN)} AS uniq_key_name FROM {CN}"
)

CW, CE = "Customer Check", "Customer Keys"
CUSTOMER_CONSTRAINTS = [
    (CW, "Warning", "CompletenessConstraint(Completeness(c_name,None))", "compl_name", "{v} = 1.0", None, False),
    (CW, "Warning", "UniquenessConstraint(Uniqueness(List(c_custkey),None))", "uniq_key", "{v} = 1.0", None, False),
    (CW, "Warning", "CompletenessConstraint(Completeness(c_mktsegment,None))", "compl_seg", "{v} >= 0.9", None, False),
    (CW, "Warning", "ComplianceConstraint(Compliance(non_negative_balance,c_acctbal >= 0,None))", "nonneg",
     "{v} >= 0.95", "balances may be negative", False),
    (CW, "Warning", "ComplianceConstraint(Compliance(c_mktsegment contained in AUTOMOBILE,BUILDING,FURNITURE,"
     "MACHINERY,`c_mktsegment` IS NULL OR `c_mktsegment` IN ('AUTOMOBILE','BUILDING','FURNITURE','MACHINERY'),None))",
     "in_seg", "{v} = 1.0", None, False),
    (CW, "Warning", "SizeConstraint(Size(None))", "size", "{v} > 0", None, True),
    (CE, "Error", "CompletenessConstraint(Completeness(c_custkey,None))", "compl_key", "{v} = 1.0", None, False),
    (CE, "Error", "UniquenessConstraint(Uniqueness(List(c_custkey, c_name),None))", "uniq_key_name", "{v} = 1.0",
     None, False),
]

ORACLE = {
    "check_suite": _suite(ORDERS_METRICS, ON, ORDERS_CONSTRAINTS, ", 'billing' AS team"),
    "check_suite_warning": _suite(CUSTOMER_METRICS, CN, CUSTOMER_CONSTRAINTS),
}

_CS = ("(SELECT c_custkey, c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, 'HOUSEHOLD') AS c_mktsegment, "
       "CAST(c_nationkey AS VARCHAR) AS nation_text FROM customer)")


Q = "'"  # single quote, for SQL text built below


def _row(c, constraint, current, description, predicate, code, tail):
    return (f"SELECT '{c}' AS column_name, '{constraint}' AS constraint, {current} AS current_value, "
            f"'{Q}{Q}{c}{Q}{Q} ' || {description} AS description, {predicate} AS predicate, {code} AS code_for_constraint {tail}")


def _complete(c, src):
    return _row(c, "isComplete", "'Completeness: 1.0'", "'is not null'", f"'`{c}` IS NOT NULL'", f"'.isComplete(\"{c}\")'",
                f"FROM {src} HAVING count({c}) = count(*) AND count(*) > 0")


def _nonneg(c, src):
    return _row(c, "isNonNegative", f"'Minimum: ' || CAST(CAST(min({c}) AS DOUBLE) AS VARCHAR)", "'has no negative values'",
                f"'`{c}` IS NULL OR `{c}` >= 0'", f"'.isNonNegative(\"{c}\")'", f"FROM {src} HAVING min({c}) >= 0")


def _unique(c, src):
    """Complete columns with as many distinct values as rows."""
    return _row(c, "isUnique", "'Distinctness: 1.0'", "'is unique'", "CAST(NULL AS VARCHAR)", f"'.isUnique(\"{c}\")'",
                f"FROM {src} HAVING count(DISTINCT {c}) = count(*) AND count(*) > 0")


def _contained(c, src):
    """Seen values by count, then text; only for columns with at most 120 bins (null
    included) whose distinct non-null values are at most 10% of the non-null rows."""
    freq = f"(SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {src} GROUP BY 1)"
    vals = "(SELECT string_agg({q} || v || {q}, ', ' ORDER BY n DESC, v ASC) FROM " + freq + " WHERE v IS NOT NULL)"
    cond = (f"(SELECT count(*) FROM {freq}) <= 120 AND (SELECT count(*) FROM {freq} WHERE v IS NOT NULL) > 0 "
            f"AND (SELECT count(*) FROM {freq} WHERE v IS NOT NULL) <= 0.1 * (SELECT count({c}) FROM {src})")
    single, double = vals.format(q=Q * 4), vals.format(q=Q + '"' + Q)
    return _row(c, "isContainedIn", "'Compliance: 1'", f"'has value range ' || {single}",
                f"'`{c}` IS NULL OR `{c}` IN (' || {single} || ')'", f"'.isContainedIn(\"{c}\", [' || {double} || '])'", f"WHERE {cond}")


_P = "CAST(count(c_mktsegment) AS DOUBLE) / CAST(count(*) AS DOUBLE)"
_TARGET = f"floor(({_P} - 1.96 * sqrt({_P} * (1.0 - {_P}) / count(*))) * 100) / 100.0"
_DIGITS = ("(SELECT count_if(regexp_matches(nation_text, '^[+-]?\\d+$')) AS i, count(nation_text) AS nn "
           f"FROM {_CS})")

ORACLE["suggest_constraints"] = "\nUNION ALL\n".join(
    [
        _complete("c_custkey", _CS), _complete("c_name", _CS), _complete("c_nationkey", _CS),
        _complete("c_acctbal", _CS), _complete("c_mktsegment", _CS), _complete("nation_text", _CS),
        _row("c_mktsegment", "hasCompleteness", f"'Completeness: ' || CAST({_P} AS VARCHAR)",
             f"'has completeness of at least ' || CAST({_TARGET} AS VARCHAR)", "CAST(NULL AS VARCHAR)",
             f"'.hasCompleteness(\"c_mktsegment\", lambda x: x >= ' || CAST({_TARGET} AS VARCHAR) || ')'",
             f"FROM {_CS} HAVING {_P} > 0.2 AND {_P} < 1.0"),
        _row("nation_text", "hasDataType", "'DataType: Integral'", "'has type Integral'", "CAST(NULL AS VARCHAR)",
             "'.hasDataType(\"nation_text\", ConstrainableDataTypes.Integral)'", f"FROM {_DIGITS} WHERE nn > 0 AND i = nn"),
        *[_unique(c, _CS) for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "nation_text")],
        _contained("c_nationkey", _CS), _contained("c_mktsegment", _CS), _contained("nation_text", _CS),
        _nonneg("c_custkey", _CS), _nonneg("c_nationkey", _CS), _nonneg("c_acctbal", _CS),
    ]
)


def _ratio(a, b):
    return f"CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE)"


_DIST = ("(SELECT CAST(count(*) AS DOUBLE) / CAST(sum(n) AS DOUBLE) FROM "
         "(SELECT {c}, count(*) AS n FROM " + ON + " WHERE {c} IS NOT NULL GROUP BY {c}))")

_URGENT = _ratio("count_if(o_orderpriority = '1-URGENT')", "count(*)")
PROFILE_METRICS = (
    f"SELECT CAST(count(*) AS DOUBLE) AS size, {_ratio('count(o_orderkey)', 'count(*)')} AS compl_key, "
    f"CAST(count(DISTINCT o_orderkey) AS DOUBLE) AS cd_key, {_DIST.format(c='o_orderkey')} AS dist_key, "
    f"{_ratio('count(o_orderpriority)', 'count(*)')} AS compl_prio, "
    f"{_URGENT} AS urgent, "
    f"CAST(count(DISTINCT o_orderstatus) AS DOUBLE) AS cd_status, {_DIST.format(c='o_custkey')} AS dist_cust "
    f"FROM {ON}"
)

ORACLE["rule_profile_metrics"] = "\nUNION ALL\n".join(
    f"SELECT '{e}' AS entity, '{i}' AS instance, '{n}' AS name, {col} AS value FROM ({PROFILE_METRICS})"
    for e, i, n, col in [
        ("Dataset", "*", "Size", "size"),
        ("Column", "o_orderkey", "Completeness", "compl_key"),
        ("Column", "o_orderkey", "CountDistinct", "cd_key"),
        ("Column", "o_orderkey", "Distinctness", "dist_key"),
        ("Column", "o_orderpriority", "Completeness", "compl_prio"),
        ("Column", "priority_urgent", "Compliance", "urgent"),
        ("Column", "o_orderstatus", "CountDistinct", "cd_status"),
        ("Column", "o_custkey", "Distinctness", "dist_cust"),
    ]
)

_E, _W = "sales.orders Error", "sales.orders Warning"
ORACLE["rule_profile_checks"] = _suite(
    PROFILE_METRICS,
    ON,
    [
        (_E, "Error", "SizeConstraint(Size(None))", "size", "{v} > 8", None, True),
        (_E, "Error", "CompletenessConstraint(Completeness(o_orderkey,None))", "compl_key", "{v} = 1.0", None, False),
        (_W, "Warning", "CountDistinctConstraint(CountDistinct(List(o_orderkey),None))", "cd_key", "{v} >= 1000",
         None, True),
        (_W, "Warning", "DistinctnessConstraint(Distinctness(List(o_orderkey),None))", "dist_key", "{v} = 1.0",
         None, False),
        (_W, "Warning", "CompletenessConstraint(Completeness(o_orderpriority,None))", "compl_prio", "{v} >= 0.9",
         None, False),
        (_W, "Warning", "ComplianceConstraint(Compliance(priority_urgent,o_orderpriority = '1-URGENT',None))",
         "urgent", "{v} >= 0.5", None, False),
        (_E, "Error", "CountDistinctConstraint(CountDistinct(List(o_orderstatus),None))", "cd_status", "{v} = 3",
         None, True),
        (_W, "Warning", "DistinctnessConstraint(Distinctness(List(o_custkey),None))", "dist_cust", "{v} >= 0.5",
         None, False),
    ],
)

_RANK = "CASE WHEN c_custkey % 37 = 0 THEN 'gold' WHEN c_custkey % 5 = 1 THEN 'silver' ELSE 'plain' END AS rank"
_TRAIN = f"(SELECT *, {_RANK} FROM {_CS} WHERE c_custkey % 5 <> 0)"
_HELD = f"(SELECT *, {_RANK} FROM {_CS} WHERE c_custkey % 5 = 0)"
_SIZE = f"(SELECT count(*) FROM {_HELD})"


def _evaluated(suggestion, value, least="1.0"):
    return (f"SELECT column_name, \"constraint\", description, round(v, 6) AS holdout_value, {_SIZE} AS holdout_rows, v >= {least} AS holds "
            f"FROM ({suggestion}), (SELECT {value} AS v FROM {_HELD})")


def _seen(c, src):
    return f"(SELECT DISTINCT CAST({c} AS VARCHAR) FROM {src} WHERE {c} IS NOT NULL)"


def _uniqueness_of(c):
    return (f"any_value((SELECT CAST(count_if(n = 1) AS DOUBLE) / sum(n) FROM (SELECT count(*) AS n FROM {_HELD} WHERE {c} IS NOT NULL GROUP BY {c})))")


_SHARE = "floor((cov - 1.96 * sqrt(cov * (1.0 - cov) / t)) * 100) / 100.0"


def _fractional(c):
    """The most common values that cover 90 % of the non-null rows, if they are not all."""
    freq = f"(SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {_TRAIN} WHERE {c} IS NOT NULL GROUP BY 1)"
    run = f"(SELECT v, n, sum(n) OVER (ORDER BY n DESC, v ROWS UNBOUNDED PRECEDING) - n AS before, sum(n) OVER () AS total FROM {freq})"
    top = f"(SELECT * FROM {run} WHERE before < 0.9 * total)"
    cover = (f"(SELECT sum(n) / CAST(max(total) AS DOUBLE) AS cov, max(total) AS t, string_agg({Q * 4} || v || {Q * 4}, ', ' ORDER BY n DESC, v) AS vs, "
             f"count(*) AS k FROM {top})")
    return _evaluated(
        _row(c, "isContainedIn", "''", f"'has value range ' || vs || ' for at least ' || CAST({_SHARE} AS VARCHAR) || ' of values'", "''", "''",
             f"FROM {cover} WHERE k < (SELECT count(*) FROM {freq})"),
        f"count_if({c} IS NULL OR CAST({c} AS VARCHAR) IN (SELECT v FROM {top})) / CAST(count(*) AS DOUBLE)", f"(SELECT {_SHARE} FROM {cover})")


_COMPLETE = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "nation_text", "rank")
ORACLE["suggest_evaluated"] = "\nUNION ALL\n".join(
    [
        *[_evaluated(_complete(c, _TRAIN), f"count({c}) / CAST(count(*) AS DOUBLE)") for c in (*_COMPLETE, "c_mktsegment")],
        _evaluated(_row("c_mktsegment", "hasCompleteness", "''", f"'has completeness of at least ' || CAST({_TARGET} AS VARCHAR)", "''", "''",
                        f"FROM {_TRAIN} HAVING {_P} > 0.2 AND {_P} < 1.0"), _P, f"(SELECT {_TARGET} FROM {_TRAIN})"),
        _evaluated(_row("nation_text", "hasDataType", "''", "'has type Integral'", "''", "''", f"FROM (SELECT 1)"),
                   "count_if(nation_text IS NULL OR regexp_matches(nation_text, '^[+-]?\\d+$')) / CAST(count(*) AS DOUBLE)"),
        *[_evaluated(_unique(c, _TRAIN), _uniqueness_of(c)) for c in (*_COMPLETE, "c_mktsegment")],
        *[_evaluated(_contained(c, _TRAIN), f"count_if({c} IS NULL OR CAST({c} AS VARCHAR) IN {_seen(c, _TRAIN)}) / CAST(count(*) AS DOUBLE)")
          for c in ("c_nationkey", "c_mktsegment", "nation_text", "rank")],
        *[_evaluated(_nonneg(c, _TRAIN), f"count_if({c} IS NULL OR {c} >= 0) / CAST(count(*) AS DOUBLE)")
          for c in ("c_custkey", "c_nationkey", "c_acctbal")],
        *[_fractional(c) for c in ("c_nationkey", "c_mktsegment", "nation_text", "rank")],
    ]
)
