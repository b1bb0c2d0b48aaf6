"""DuckDB oracle SQL for metrics from stored states: one pass over the whole table."""

from qualia.plans.oracle_metrics import _completeness, _count_distinct, _distinctness, _m, _ratio, _u, _uniqueness

LI = "(SELECT *, nullif(l_linestatus, 'F') AS l_shipmode_seen FROM lineitem)"
SOME = "(SELECT *, nullif(l_linestatus, 'F') AS l_shipmode_seen FROM lineitem WHERE year(l_shipdate) <= 1996 OR year(l_shipdate) > 1998)"

_HISTOGRAM = [
    f"SELECT 'Column' AS entity, 'l_shipmode_seen' AS instance, 'Histogram.bins' AS name, "
    f"CAST((SELECT count(*) FROM (SELECT DISTINCT l_shipmode_seen FROM {LI})) AS DOUBLE) AS value",
    f"SELECT 'Column', 'l_shipmode_seen', 'Histogram.abs.' || coalesce(l_shipmode_seen, 'NullValue'), CAST(count(*) AS DOUBLE) "
    f"FROM {LI} GROUP BY l_shipmode_seen",
    f"SELECT 'Column', 'l_shipmode_seen', 'Histogram.ratio.' || coalesce(l_shipmode_seen, 'NullValue'), "
    f"CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM lineitem) FROM {LI} GROUP BY l_shipmode_seen",
]


def _rounded(sql):
    return f"SELECT entity, instance, name, round(value, 6) AS value FROM ({sql})"


ORACLE = {
    "metric_states_lineitem": _rounded(_u(
        _m("Dataset", "*", "Size", "count(*)", LI),
        _m("Dataset", "*", "Size (where: l_returnflag = ''R'')", "count_if(l_returnflag = 'R')", LI),
        _completeness("l_shipmode_seen", LI),
        _m("Column", "big", "Compliance", _ratio("count_if(l_quantity > 25)", "count(*)"), LI),
        _m("Column", "big_returned", "Compliance (where: l_returnflag = ''R'')",
           _ratio("count_if(l_quantity > 25 AND l_returnflag = 'R')", "count_if(l_returnflag = 'R')"), LI),
        _m("Column", "l_quantity", "Sum", "sum(l_quantity)", LI),
        _m("Column", "l_extendedprice", "Mean", "avg(l_extendedprice)", LI),
        _m("Column", "l_extendedprice", "StandardDeviation", "stddev_pop(l_extendedprice)", LI),
        _m("Column", "l_discount", "Minimum", "min(l_discount)", LI),
        _m("Column", "l_tax", "Maximum", "max(l_tax)", LI),
        _m("Column", "l_shipmode_seen", "MaxLength", "max(length(l_shipmode_seen))", LI),
        _distinctness("Column", "l_partkey", "l_partkey", LI),
        _uniqueness("Column", "l_orderkey", "l_orderkey", LI),
        _count_distinct("l_suppkey", LI),
        _uniqueness("Multicolumn", "l_orderkey,l_linenumber", "l_orderkey,l_linenumber", LI),
        *_HISTOGRAM,
    )),
    "metric_states_some": _rounded(_u(
        _m("Dataset", "*", "Size", "count(*)", SOME),
        _m("Column", "l_quantity", "Mean", "avg(l_quantity)", SOME),
        _m("Column", "l_quantity", "StandardDeviation", "stddev_pop(l_quantity)", SOME),
        _count_distinct("l_partkey", SOME),
        _completeness("l_shipmode_seen", SOME),
    )),
    "metric_states_sketches": (
        "SELECT unnest(['l_orderkey', 'l_partkey', 'l_suppkey']) AS instance, 'ApproxCountDistinct' AS name, TRUE AS within_bound\n"
        "UNION ALL SELECT 'l_extendedprice', unnest(['ApproxQuantile-0.5', 'ApproxQuantile-0.9']), TRUE"
    ),
}
