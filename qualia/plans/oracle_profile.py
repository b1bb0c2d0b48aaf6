"""DuckDB oracle SQL for the profile queries."""

ORDERS_DIRTY = (
    "(SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
    "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL WHEN o_orderpriority = '5-LOW' THEN '' "
    "WHEN o_orderpriority = '3-MEDIUM' THEN '   ' ELSE o_orderpriority END AS o_orderpriority FROM orders)"
)

DOCS_DIRTY = (
    "(SELECT CASE WHEN d.lang = 'es' THEN '' WHEN d.lang = 'de' THEN '   ' ELSE d.lang END AS lang, l.quality, "
    "CASE WHEN d.n_chars > 5000 THEN 'NaN'::DOUBLE ELSE CAST(d.n_chars AS DOUBLE) END AS n_chars, d.source "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
)


def _canon(c, kind):
    """Floating -0.0 read as 0.0 (min/max of equal zeros is otherwise engine-dependent)."""
    return f"CASE WHEN {c} = 0 THEN 0.0::DOUBLE ELSE {c} END" if kind == "float" else c


def _u(parts):
    return "\nUNION ALL\n".join(parts)


def _freq_pick(c, src, order):
    return (
        f"(SELECT {{sel}} FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM {src} GROUP BY 1) "
        f"ORDER BY {order}, v ASC NULLS FIRST LIMIT 1)"
    )


def _profile_row(c, dtype, src, kind, schema="schema_name", tname="table_name", freq=True):
    nulls = f"count_if({c} IS NULL OR isnan({c}))" if kind == "float" else f"count_if({c} IS NULL)"
    spaces = f"count_if(regexp_matches({c}, '^\\s+$'))" if kind == "str" else "0"
    blank = f"count_if({c} = '')" if kind == "str" else "0"
    num = kind in ("int", "float")
    mean = f"round(avg({c}), 4)" if num else "CAST(NULL AS DOUBLE)"
    std = f"round(stddev_samp({c}), 4)" if num else "CAST(NULL AS DOUBLE)"
    cols = [
        f"'{schema}' AS schema_name", f"'{tname}' AS table_name", f"'{c}' AS column_names",
        f"'{dtype}' AS data_types", "count(*) AS num_rows", f"{nulls} AS num_null", f"{spaces} AS num_spaces",
        f"{blank} AS num_blank", f"count({c}) AS count", f"{mean} AS mean", f"{std} AS stddev",
        f"CAST(min({_canon(c, kind)}) AS VARCHAR) AS min", f"CAST(max({_canon(c, kind)}) AS VARCHAR) AS max",
    ]
    if freq:
        most = _freq_pick(c, src, "n DESC")
        least = _freq_pick(c, src, "n ASC")
        cols += [
            f"(SELECT count(*) FROM (SELECT {c} FROM {src} GROUP BY {c})) AS num_distinct",
            most.format(sel="v") + " AS most_freq_value",
            most.format(sel="n") + " AS most_freq_value_count",
            least.format(sel="v") + " AS least_freq_value",
            least.format(sel="n") + " AS least_freq_value_count",
        ]
    return f"SELECT {', '.join(cols)} FROM {src}"


ORACLE = {}

ORACLE["profile_basic"] = _u(
    [
        _profile_row(c, t, ORDERS_DIRTY, k, tname="orders")
        for c, t, k in [
            ("o_orderkey", "bigint", "int"),
            ("o_custkey", "bigint", "int"),
            ("o_orderstatus", "string", "str"),
            ("o_totalprice", "double", "float"),
            ("o_orderdate", "timestamp_ntz", "other"),
            ("o_orderpriority", "string", "str"),
        ]
    ]
)

ORACLE["profile_frequencies"] = (
    "SELECT column_names, num_distinct, most_freq_value, most_freq_value_count, least_freq_value, "
    "least_freq_value_count FROM ("
    + _u(
        [
            _profile_row(c, t, "lineitem", k)
            for c, t, k in [
                ("l_returnflag", "string", "str"),
                ("l_linestatus", "string", "str"),
                ("l_linenumber", "int", "int"),
                ("l_suppkey", "bigint", "int"),
                ("l_shipdate", "timestamp_ntz", "other"),
            ]
        ]
    )
    + ")"
)

_KEYED = "(SELECT *, l_orderkey || '-' || l_linenumber AS l_comment_key FROM lineitem)"
ORACLE["profile_extremes"] = (
    "SELECT column_names AS column_name, most_freq_value, most_freq_value_count, least_freq_value, least_freq_value_count FROM ("
    + _u(
        [
            _profile_row(c, "", src, "other")
            for c, src in [
                *[(c, _KEYED) for c in ["l_returnflag", "l_linenumber", "l_suppkey", "l_shipdate", "l_orderkey", "l_extendedprice",
                                        "l_comment_key"]],
                *[(c, ORDERS_DIRTY) for c in ["o_orderkey", "o_orderpriority", "o_custkey"]],
            ]
        ]
    )
    + ")"
)

ORACLE["profile_numeric"] = _u(
    [
        f"SELECT '{c}' AS column_name, CAST(count({c}) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS completeness, "
        f"round(avg({c}), 4) AS mean, round(CAST(max({c}) AS DOUBLE), 4) AS maximum, "
        f"round(CAST(min({c}) AS DOUBLE), 4) AS minimum, round(sum({c}), 2) AS sum, "
        f"round(stddev_pop({c}), 4) AS std_dev FROM lineitem"
        for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    ]
)

ORACLE["profile_sample_stats"] = _u(
    [
        f"SELECT '{c}' AS column_names, count({c}) AS count, round(avg({c}), 4) AS mean, "
        f"round(stddev_samp({c}), 4) AS stddev FROM lineitem"
        for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    ]
)

ORACLE["profile_min_max"] = _u(
    [
        f"SELECT '{c}' AS column_names, '{t}' AS data_types, CAST(min({_canon(c, k)}) AS VARCHAR) AS min, "
        f"CAST(max({_canon(c, k)}) AS VARCHAR) AS max FROM events"
        for c, t, k in [
            ("ts", "timestamp_ntz", "other"),
            ("event_type", "string", "str"),
            ("user_id", "bigint", "int"),
            ("value", "double", "float"),
            ("props", "string", "str"),
        ]
    ]
)

EVENTS_TEXT = (
    "(SELECT regexp_extract(props, '(\\d+)', 1) AS props_digits, event_type, CAST(value AS VARCHAR) AS value_text, "
    "CASE WHEN value > 50 THEN 'true' WHEN value > 10 THEN 'false' END AS is_big, "
    "CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS user_text, user_id FROM events)"
)


def _type_row(c):
    b = f"count_if(regexp_matches({c}, '^(true|false)$'))"
    f = f"count_if(regexp_matches({c}, '^[+-]?\\d*\\.\\d+$'))"
    i = f"count_if(regexp_matches({c}, '^[+-]?\\d+$'))"
    nn = f"count({c})"
    s = f"({nn} - {b} - {f} - {i})"
    dtype = (
        f"CASE WHEN {nn} = 0 THEN 'Unknown' WHEN {s} > 0 THEN 'String' WHEN {b} > 0 AND ({i} > 0 OR {f} > 0) "
        f"THEN 'String' WHEN {b} > 0 THEN 'Boolean' WHEN {f} > 0 THEN 'Fractional' ELSE 'Integral' END"
    )
    return (
        f"SELECT '{c}' AS column_name, {dtype} AS data_type, ({dtype}) NOT IN ('String', 'Unknown') "
        f"AS is_data_type_inferred, {b} AS n_boolean, {f} AS n_fractional, {i} AS n_integral, "
        f"count(*) - {nn} AS n_unknown, {s} AS n_string FROM {EVENTS_TEXT}"
    )


ORACLE["profile_types"] = _u(
    [_type_row(c) for c in ["props_digits", "event_type", "value_text", "is_big", "user_text"]]
    + [
        "SELECT 'user_id' AS column_name, 'Integral' AS data_type, FALSE AS is_data_type_inferred, "
        "0 AS n_boolean, 0 AS n_fractional, 0 AS n_integral, 0 AS n_unknown, 0 AS n_string"
    ]
)

ORACLE["profile_approx_distinct"] = _u(
    [
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count, TRUE AS within_bound FROM lineitem"
        for c in ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"]
    ]
)

ORACLE["profile_percentiles"] = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS percentile, CAST(quantile_disc({c}, {p}) AS DOUBLE) AS value FROM part"
    for c in ("p_retailprice", "p_size") for p in (0.1, 0.25, 0.5, 0.75, 0.9)
)

ORACLE["profile_histogram_wide"] = """
WITH f AS (SELECT CAST(user_id AS VARCHAR) AS v, count(*) AS n FROM events GROUP BY user_id)
SELECT 'user_id' AS column_name, coalesce(v, 'NullValue') AS value, n AS count,
  CAST(n AS DOUBLE) / CAST((SELECT sum(n) FROM f) AS DOUBLE) AS ratio, (SELECT count(*) FROM f) AS bins,
  (SELECT count(*) FROM f) <= 120 AS histogram_kept
FROM f
"""

ORACLE["profile_histogram"] = """
WITH e AS (SELECT CAST(nullif(event_type, 'error') AS VARCHAR) AS v FROM events),
fe AS (SELECT v, count(*) AS n FROM e GROUP BY v),
fc AS (SELECT CAST(role AS VARCHAR) AS v, count(*) AS n FROM conversations GROUP BY role)
SELECT 'event_type' AS column_name, coalesce(v, 'NullValue') AS value, n AS count,
  CAST(n AS DOUBLE) / CAST((SELECT sum(n) FROM fe) AS DOUBLE) AS ratio FROM fe
UNION ALL
SELECT 'role', coalesce(v, 'NullValue'), n, CAST(n AS DOUBLE) / CAST((SELECT sum(n) FROM fc) AS DOUBLE) FROM fc
"""

ORACLE["null_blank_space_counts"] = (
    "SELECT column_names, num_rows, num_null, num_spaces, num_blank, count FROM ("
    + _u(
        [
            _profile_row(c, t, DOCS_DIRTY, k, freq=False)
            for c, t, k in [
                ("lang", "string", "str"),
                ("quality", "int", "int"),
                ("n_chars", "double", "float"),
                ("source", "string", "str"),
            ]
        ]
    )
    + ")"
)
