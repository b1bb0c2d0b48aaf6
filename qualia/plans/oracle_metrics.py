"""DuckDB oracle SQL for the metric queries."""

DL = "(SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
ON = ("(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
      "nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority FROM orders)")


def _m(entity, instance, name, value_sql, src):
    return f"SELECT '{entity}' AS entity, '{instance}' AS instance, '{name}' AS name, CAST({value_sql} AS DOUBLE) AS value FROM {src}"


def _u(*parts):
    return "\nUNION ALL\n".join(parts)


def _ratio(a, b):
    return f"CASE WHEN {b} <> 0 THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"


def _freq_metric(entity, instance, name, keys, src, value):
    """value over per-key counts n with nn = any key non-null."""
    nn = " OR ".join(f"{k} IS NOT NULL" for k in keys.split(","))
    return (
        f"SELECT '{entity}' AS entity, '{instance}' AS instance, '{name}' AS name, CAST({value} AS DOUBLE) AS value "
        f"FROM (SELECT count(*) AS n, ({nn}) AS nn FROM {src} GROUP BY {keys})"
    )


def _distinctness(entity, instance, keys, src):
    return _freq_metric(entity, instance, "Distinctness", keys, src,
                        _ratio("count_if(nn)", "sum(CASE WHEN nn THEN n END)"))


def _uniqueness(entity, instance, keys, src):
    return _freq_metric(entity, instance, "Uniqueness", keys, src,
                        _ratio("count_if(nn AND n = 1)", "sum(CASE WHEN nn THEN n END)"))


def _count_distinct(col, src):
    return _m("Column", col, "CountDistinct", f"count(DISTINCT {col})", src)


def _completeness(col, src, where=None):
    w = where or "TRUE"
    name = f"Completeness (where: {where})".replace("'", "''") if where else "Completeness"
    return _m("Column", col, name, _ratio(f"count_if(({w}) AND {col} IS NOT NULL)", f"count_if({w})"), src)


ORACLE = {
    "metric_size": _m("Dataset", "*", "Size", "count(*)", DL),
    "metric_completeness": _u(_completeness("quality", DL), _completeness("toxic", DL), _completeness("lang", DL)),
    "metric_completeness_where": _u(
        _completeness("quality", DL, "lang = 'en'"),
        _completeness("toxic", DL, "source = 'src3'"),
        _m("Dataset", "*", "Size (where: lang = ''de'')", "count_if(lang = 'de')", DL),
    ),
    "metric_distinctness": _u(
        _distinctness("Column", "l_orderkey", "l_orderkey", "lineitem"),
        _distinctness("Column", "l_partkey", "l_partkey", "lineitem"),
        _distinctness("Column", "l_returnflag", "l_returnflag", "lineitem"),
    ),
    "metric_uniqueness": _u(
        _uniqueness("Column", "o_custkey", "o_custkey", ON),
        _uniqueness("Column", "o_orderkey", "o_orderkey", ON),
        _uniqueness("Column", "o_orderpriority", "o_orderpriority", ON),
    ),
    "metric_uniqueness_multi": _u(
        _uniqueness("Multicolumn", "l_orderkey,l_linenumber", "l_orderkey,l_linenumber", "lineitem"),
        _distinctness("Multicolumn", "l_orderkey,l_linenumber", "l_orderkey,l_linenumber", "lineitem"),
        _uniqueness("Multicolumn", "l_returnflag,l_linestatus", "l_returnflag,l_linestatus", "lineitem"),
    ),
    "metric_count_distinct": _u(
        _count_distinct("o_custkey", ON), _count_distinct("o_orderstatus", ON), _count_distinct("o_orderpriority", ON)
    ),
    "metric_compliance": _u(
        _m("Column", "priority_urgent_or_high", "Compliance",
           _ratio("count_if(o_orderpriority in ('1-URGENT', '2-HIGH'))", "count(*)"), ON),
        _m("Column", "big_order", "Compliance", _ratio("count_if(o_totalprice > 300000)", "count(*)"), ON),
        _m("Column", "big_open_order", "Compliance (where: o_orderstatus = ''O'')",
           _ratio("count_if(o_orderstatus = 'O' AND o_totalprice > 300000)", "count_if(o_orderstatus = 'O')"), ON),
    ),
    "metric_lengths": _u(
        _m("Column", "text", "MaxLength", "max(length(text))", "documents"),
        _m("Column", "text", "MinLength", "min(length(text))", "documents"),
        _m("Column", "lang", "MaxLength", "max(length(lang))", "documents"),
        _m("Column", "source", "MinLength", "min(length(source))", "documents"),
    ),
    "metric_numeric": "SELECT entity, instance, name, round(value, 6) AS value FROM (" + _u(
        _m("Column", "l_quantity", "Mean", "avg(l_quantity)", "lineitem"),
        _m("Column", "l_quantity", "Sum", "sum(l_quantity)", "lineitem"),
        _m("Column", "l_quantity", "StandardDeviation", "stddev_pop(l_quantity)", "lineitem"),
        _m("Column", "l_quantity", "Minimum", "min(l_quantity)", "lineitem"),
        _m("Column", "l_quantity", "Maximum", "max(l_quantity)", "lineitem"),
        _m("Column", "l_linenumber", "Mean", "avg(l_linenumber)", "lineitem"),
        _m("Column", "l_linenumber", "StandardDeviation", "stddev_pop(l_linenumber)", "lineitem"),
    ) + ")",
    "metric_histogram": """
WITH e AS (SELECT nullif(event_type, 'error') AS event_type, user_id, value FROM events),
f1 AS (SELECT CAST(event_type AS VARCHAR) AS v, count(*) AS n FROM e GROUP BY 1),
f2 AS (SELECT CAST(user_id AS VARCHAR) AS v, count(*) AS n FROM e WHERE value > 50 GROUP BY 1)
SELECT 'Column' AS entity, 'event_type' AS instance, 'Histogram.bins' AS name, CAST(count(*) AS DOUBLE) AS value FROM f1
UNION ALL SELECT 'Column', 'event_type', 'Histogram.abs.' || coalesce(v, 'NullValue'), CAST(n AS DOUBLE) FROM f1
UNION ALL SELECT 'Column', 'event_type', 'Histogram.ratio.' || coalesce(v, 'NullValue'),
  CAST(n AS DOUBLE) / CAST((SELECT sum(n) FROM f1) AS DOUBLE) FROM f1
UNION ALL SELECT 'Column', 'user_id', 'Histogram.bins (where: value > 50)', CAST(count(*) AS DOUBLE) FROM f2
UNION ALL SELECT 'Column', 'user_id', 'Histogram.abs.' || coalesce(v, 'NullValue') || ' (where: value > 50)',
  CAST(n AS DOUBLE) FROM f2
UNION ALL SELECT 'Column', 'user_id', 'Histogram.ratio.' || coalesce(v, 'NullValue') || ' (where: value > 50)',
  CAST(n AS DOUBLE) / CAST((SELECT sum(n) FROM f2) AS DOUBLE) FROM f2
""",
}

_C = "(SELECT c_custkey, c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, 'HOUSEHOLD') AS c_mktsegment FROM customer)"
ORACLE["metrics_from_config"] = _u(
    _completeness("c_custkey", _C),
    _completeness("c_name", _C),
    _completeness("c_mktsegment", _C),
    _completeness("c_nationkey", _C),
    _distinctness("Column", "c_nationkey", "c_nationkey", _C),
    _distinctness("Column", "c_mktsegment", "c_mktsegment", _C),
    _uniqueness("Column", "c_name", "c_name", _C),
    _uniqueness("Column", "c_custkey", "c_custkey", _C),
    _m("Column", "c_name", "MaxLength", "max(length(c_name))", _C),
    _m("Column", "c_mktsegment", "MaxLength", "max(length(c_mktsegment))", _C),
    _m("Column", "c_name", "MinLength", "min(length(c_name))", _C),
)

_FAILED = "SELECT 'Column' AS entity, '{}' AS instance, '{}' AS name, CAST(NULL AS DOUBLE) AS value, TRUE AS failed"
ORACLE["metrics_from_config"] = (
    f"SELECT *, FALSE AS failed FROM ({ORACLE['metrics_from_config']}) UNION ALL " + _FAILED.format("c_acctbal", "MinLength")
)
ORACLE["metric_errors"] = "\nUNION ALL\n".join([
    "SELECT 'Dataset' AS entity, '*' AS instance, 'Size' AS name, CAST(count(*) AS DOUBLE) AS value, FALSE AS failed FROM orders",
    "SELECT 'Column', 'o_orderstatus', 'CountDistinct', CAST(count(DISTINCT o_orderstatus) AS DOUBLE), FALSE FROM orders",
    "SELECT 'Column', 'o_totalprice', 'Mean (where: o_orderstatus = ''no such status'')', CAST(NULL AS DOUBLE), FALSE",
    _FAILED.format("o_comment_missing", "Completeness"), _FAILED.format("o_totalprice", "MaxLength"),
    _FAILED.format("typo", "Compliance"), _FAILED.format("o_orderkey,nowhere", "Uniqueness").replace("'Column'", "'Multicolumn'"),
])
