"""Rule metrics of many entities in one plan (S3, Q4).

A table that holds the rows of many entities (one column names the entity) is scanned once for the rules of all of
them: each row becomes one small row per rule *of its own entity* (``CASE entity WHEN ... THEN array(...)``), which
partial aggregation folds into counters before the shuffle. No rule runs on another entity's rows, the plan
grows with the rules and not with scans, and a hot entity costs one row per rule and task. Aggregate rules that need
distinct values take a second scan of their columns, for all entities together.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualia.functions.predicates import RuleError, parse_slo, pct_half_up_sql, quote_ident, resolve_name, rule_sql, str_lit
from qualia.operators.validate import Rule, _build, _resolved, as_rules

# Aggregate rules understood per entity.
COUNTED = ("uniqueness", "distinctness", "completeness", "hassize")
_SLO = (("gt", ">"), ("lt", "<"), ("eq", "="), ("ge", ">="), ("le", "<="))


def rules_by_entity(rules) -> dict[str, list[Rule]]:
    """Active rules by entity, from a canonical rules DataFrame (one read), dicts or ``Rule`` objects."""
    if isinstance(rules, DataFrame):
        if "in_scope" in rules.columns:
            rules = rules.where(F.coalesce("in_scope", F.lit(True)))
        items = [r.asDict() for r in rules.collect()]  # configuration: compiled into the plan
    else:
        items = list(rules)
    by_entity: dict[str, list] = {}
    for r in items:
        entity = r.entity if isinstance(r, Rule) else r.get("entity") if isinstance(r, Mapping) else r["entity"]
        by_entity.setdefault(entity, []).append(r)
    return {e: [r for r in as_rules(own) if r.kind != "profile"] for e, own in sorted(by_entity.items(), key=lambda kv: str(kv[0]))}


def rule_metrics_by_entity(df: DataFrame, rules, entity: str) -> DataFrame:
    """``rule_metrics`` of every entity's rules on its own rows of ``df``; ``entity`` is SQL text that gives a row's entity.
    An entity without rows has counts of 0."""
    owned = [(i, e, r) for i, (e, r) in enumerate((e, r) for e, own in rules_by_entity(rules).items() for r in own)]
    if not owned:
        raise ValueError("no active rules")
    row_items: dict[str, list[str]] = {}
    value_items: dict[str, list[str]] = {}
    described, compiled = [], []
    for i, e, r in owned:
        try:
            slo = parse_slo(r.slo)
        except ValueError as err:
            raise RuleError(r.rule_name, r.rule, str(err)) from err
        kind = (r.rule or "").strip().lower() if r.is_aggregate else "row"
        if r.is_aggregate and kind not in COUNTED:
            raise RuleError(r.rule_name, r.rule, f"unknown aggregate rule; use one of {', '.join(COUNTED)}")
        column = (r.element or "*") if kind == "hassize" else _resolved(df, [r])[0][1]
        if kind in ("uniqueness", "distinctness"):
            # a value's text with its presence: distinct texts are distinct values
            value_items.setdefault(e, []).append(f"named_struct('i', {i}, 'v', CAST({quote_ident(column)} AS STRING))")
        else:
            test = {"row": rule_sql(r.rule), "completeness": f"{quote_ident(column)} IS NOT NULL", "hassize": "TRUE"}[kind]
            row_items.setdefault(e, []).append(f"named_struct('i', {i}, 'ok', {test})")
            if kind == "row":
                compiled.append((r, column))
        described.append((i, r.source, e, column, r.rule, r.rule_name, r.dimension, kind, slo[0] if slo else None, slo[1] if slo else None))

    def exploded(items: dict[str, list[str]], struct: str) -> DataFrame:
        cases = " ".join(f"WHEN {str_lit(e)} THEN array({', '.join(own)})" for e, own in items.items())
        return df.selectExpr(f"inline(CAST(CASE {entity} {cases} END AS array<{struct}>))")

    def make() -> DataFrame:
        parts = []
        if row_items:
            parts.append(exploded(row_items, "struct<i:int,ok:boolean>").groupBy("i").agg(
                F.count_if("ok").alias("s"), F.count("ok").alias("c"), F.count(F.lit(1)).alias("n")))
        if value_items:
            values = exploded(value_items, "struct<i:int,v:string>").groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
            parts.append(values.groupBy("i").agg(
                F.count("v").alias("s"), F.coalesce(F.sum(F.when(F.col("v").isNotNull(), F.col("n"))), F.lit(0)).alias("c"), F.sum("n").alias("n")))
        counts = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        rules_table = df.sparkSession.createDataFrame(
            described, "i int, source string, entity string, rule_applied_on string, rule string, rule_name string, dimension string, "
            "kind string, slo_op string, slo_value double")
        zero = F.lit(0).cast("long")
        # one row per rule on both sides (configuration)
        out = rules_table.join(F.broadcast(counts), "i", "left").withColumns({c: F.coalesce(c, zero) for c in ("s", "c", "n")})
        out = out.withColumn("total", F.when(F.col("kind") == "distinctness", F.col("c")).otherwise(F.col("n")))
        # null results of row rules count in neither
        out = out.withColumn("failed", F.when(F.col("kind") == "row", F.col("c") - F.col("s")).otherwise(F.col("total") - F.col("s")))
        pct = f"CASE WHEN kind <> 'hassize' THEN {pct_half_up_sql('s', 'total')} END"
        target = f"CASE WHEN kind = 'hassize' THEN CAST(n AS DOUBLE) ELSE ({pct}) END"
        status = " ".join(f"WHEN slo_op = '{op}' THEN {target} {sign} slo_value" for op, sign in _SLO)
        return out.selectExpr(
            "source", "entity", "rule_applied_on", "rule", "rule_name", "dimension", "s AS success_count", "failed AS failure_count",
            "total AS count", f"{pct} AS pass_percentage", f"CASE {status} END AS constraint_status")

    return _build(df, compiled, make)
