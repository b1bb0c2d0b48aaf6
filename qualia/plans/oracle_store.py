"""DuckDB oracle SQL for rule selection and the rule store, written without nesting."""

_C = "customer"
_ENT = "'account_' || CAST(c_custkey AS VARCHAR)"
_SCOLS = ("source, entity, element, level, kind, rule_name, rule, rule_type, dimension, check_level, slo, "
          "slo_op, slo_value")


def _row(element, level, kind, name, rule, rtype, dim, check_level, slo, op, val, where):
    return (
        f"SELECT lower(c_mktsegment) AS source, {_ENT} AS entity, '{element}' AS element, '{level}' AS level, "
        f"'{kind}' AS kind, {name} AS rule_name, {rule} AS rule, '{rtype}' AS rule_type, '{dim}' AS dimension, "
        f"{check_level} AS check_level, {slo} AS slo, {op} AS slo_op, CAST({val} AS DOUBLE) AS slo_value "
        f"FROM {_C} WHERE {where}"
    )


CDE_ON = "c_mktsegment <> 'AUTOMOBILE'"
KDE_ON = "c_mktsegment <> 'BUILDING'"

RULE_SELECTION = "\nUNION ALL\n".join(
    [
        _row("c_custkey", "column", "validation", "'custkey_not_null'", "'c_custkey is not null'", "non_aggregate",
             "completeness", "NULL", "'gt(90)'", "'gt'", 90, CDE_ON),
        _row("c_acctbal", "column", "validation", "'balance_floor'",
             "'c_acctbal >= ' || CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR)", "non_aggregate", "validity",
             "NULL", "'ge(50)'", "'ge'", 50, f"{CDE_ON} AND c_acctbal > 0"),
        _row("C_NationKey", "column", "validation", "'nation_known'",
             "'c_nationkey between 0 and ' || CAST(c_nationkey AS VARCHAR)", "non_aggregate", "validity", "NULL",
             "'eq(100)'", "'eq'", 100, KDE_ON),
        _row("c_custkey", "column", "profile", "'c_custkey_completeness'", "'Completeness'", "aggregate",
             "Completeness", "'Error'", "NULL", "NULL", "NULL", CDE_ON),
        _row("*", "dataset", "validation", "'record_count'", "'hasSize'", "aggregate", "size", "'Error'",
             "'gt(' || CAST(c_nationkey AS VARCHAR) || ')'", "'gt'", "c_nationkey", "TRUE"),
    ]
)

_RUN_ON = ("CASE c_mktsegment WHEN 'BUILDING' THEN 'cde' WHEN 'AUTOMOBILE' THEN 'kde' ELSE 'cde,kde' END")
# rules as sorted text: element/name/rule/slo, and element/dimension/level/slo
_VALIDATION = (
    "'C_NationKey/nation_known/c_nationkey between 0 and ' || c_nationkey || '/eq(100); c_acctbal/balance_floor/c_acctbal >= ' "
    "|| CAST(floor(c_acctbal) AS BIGINT) || '/ge(50); c_custkey/custkey_not_null/c_custkey is not null/gt(90); "
    "c_phone/phone_present/c_phone is not null/gt(90)'"
)
_PROFILER = "'c_custkey/Completeness/Error/-; c_mktsegment/Compliance/-/ge(0.4)'"
_STORE = (
    f"SELECT lower(c_mktsegment) AS source, {_ENT} AS entity, 'c_custkey' AS primary_key, {_RUN_ON} AS run_on, "
    f"'c_custkey,c_acctbal' AS cde, {_VALIDATION} AS validation, {_PROFILER} AS profiler, c_mktsegment, c_acctbal FROM customer"
)
_SUMMARY = "source, entity, primary_key, run_on, cde, validation, profiler"
_SUPPLIED = "'s_suppkey/suppkey_not_null/s_suppkey is not null/gt(90)'"
_SUPPLIER = "'supplier_' || CAST(s_suppkey AS VARCHAR)"

RULES_GET = f"SELECT {_SUMMARY} FROM ({_STORE}) WHERE source = 'furniture'"

_REPLACED = "source = 'household' AND entity LIKE 'account_1%'"
RULES_UPSERT = (
    f"SELECT {_SUMMARY} FROM ({_STORE}) WHERE NOT ({_REPLACED})\nUNION ALL\n"
    f"SELECT source, entity, 'c_name', 'cde', 'c_name', '', '' FROM ({_STORE}) WHERE {_REPLACED}\nUNION ALL\n"
    f"SELECT 'supply', {_SUPPLIER}, 's_suppkey', 'cde', 's_suppkey', {_SUPPLIED}, '' FROM supplier"
)

_UPDATED = "c_mktsegment = 'FURNITURE' AND c_acctbal > 5000"
_NEW_RULES = "'c_acctbal/balance_positive/c_acctbal > 0/gt(50); c_name/name_not_null/c_name is not null/gt(99)'"
RULES_UPDATE = (
    f"SELECT source, entity, primary_key, CASE WHEN {_UPDATED} THEN 'cde,kde' ELSE run_on END AS run_on, cde, "
    f"CASE WHEN {_UPDATED} THEN {_NEW_RULES} ELSE validation END AS validation, "
    f"CASE WHEN {_UPDATED} THEN 'c_name/Completeness/Warning/-' ELSE profiler END AS profiler FROM ({_STORE})\nUNION ALL\n"
    f"SELECT 'supply', {_SUPPLIER}, CAST(NULL AS VARCHAR), 'cde,kde', CAST(NULL AS VARCHAR), {_SUPPLIED}, "
    "'s_suppkey/Completeness/-/-' FROM supplier"
)

_SUPPLY = f"SELECT 'supply' AS source, {_SUPPLIER} AS entity, 's_suppkey' AS primary_key, 'cde' AS run_on, 's_suppkey' AS cde, {_SUPPLIED} AS validation, '' AS profiler FROM supplier"
_TOUCHED = "entity LIKE '%1'"
RULES_VERSIONS = (
    f"WITH a AS (SELECT {_SUMMARY} FROM ({_STORE})), s AS ({_SUPPLY}),\n"
    f"t AS (SELECT source, entity, primary_key, CASE WHEN {_TOUCHED} THEN 'cde,kde' ELSE run_on END AS run_on, cde, validation, profiler FROM s)\n"
    "SELECT *, v AS version, 1 AS refused FROM a, (SELECT unnest([1, 2, 3]) AS v)\n"
    "UNION ALL SELECT *, 2, 2, 1 FROM s UNION ALL SELECT *, 3, 3, 1 FROM t"
)
RULES_VERSIONS = f"SELECT {_SUMMARY}, version, refused FROM ({RULES_VERSIONS})"

ORACLE = {
    "rules_versions": RULES_VERSIONS,
    "rule_selection": RULE_SELECTION,
    "rules_get": RULES_GET,
    "rules_upsert": RULES_UPSERT,
    "rules_update": RULES_UPDATE,
}
