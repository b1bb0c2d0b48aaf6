"""Rule validation: row results (Q3) and rule metrics (Q4, aggregate rules A10).

Every active rule of one ``(source, entity)`` becomes one expression in a single plan:

* row results: one scan, ``inline(array(struct per rule))`` - no per-rule union;
* rule metrics: one aggregation holding ``count_if(rule)`` / ``count(rule)`` for all row rules
  (split into blocks only past the session's codegen field limit) and a two-level one per
  column with aggregate rules, turned long with ``inline``; the
  pass percentage and the threshold (SLO) are data-driven columns.

Rules are configuration: the selected rules of one entity are read on the driver to
compile their SQL text into the plan (their number, not the data, bounds that read).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualia.functions.predicates import (
    RuleError,
    check_rules,
    parse_slo,
    pct_half_up_sql,
    quote_ident,
    resolve_name,
    rule_sql,
    sql_literal,
    str_lit,
)
from qualia.functions.blocks import codegen_field_limit, pack

# Aggregate rule names understood in rule documents.
AGGREGATE_RULES = ("uniqueness", "completeness", "distinctness", "hassize")


@dataclass(frozen=True)
class Rule:
    element: str
    rule: str
    rule_name: str
    dimension: str | None = None
    rule_type: str = "non_aggregate"
    slo: str | None = None
    source: str | None = None
    entity: str | None = None
    rule_specification: str | None = None
    is_active: int = 1
    level: str = "column"
    check_level: str | None = None
    kind: str | None = None

    @property
    def is_aggregate(self) -> bool:
        return (self.rule_type or "non_aggregate") == "aggregate" or self.level == "dataset"


def as_rules(rules, source: str | None = None, entity: str | None = None) -> list[Rule]:
    """Rules of one ``(source, entity)`` from a canonical rules DataFrame, ``Rule`` objects or
    dicts; active ones in scope only (``in_scope``, where the rules say it). Rules of several
    entities are refused: pick one with ``source`` and ``entity`` or a filter."""
    if isinstance(rules, DataFrame):
        if "in_scope" in rules.columns:
            rules = rules.where(F.coalesce("in_scope", F.lit(True)))
        for name, value in (("source", source), ("entity", entity)):
            if value is not None and name in rules.columns:
                rules = rules.where(F.col(name) == F.lit(value))
        names = [f.name for f in fields(Rule)]
        cols = [F.col(n) if n in rules.columns else F.lit(None).alias(n) for n in names]
        items: Iterable = [r.asDict() for r in rules.select(*cols).collect()]
    else:
        items = rules
    out = []
    for r in items:
        if hasattr(r, "asDict") and not isinstance(r, Mapping):
            r = r.asDict()
        if isinstance(r, Rule):
            rule = r
        elif isinstance(r, Mapping):
            if r.get("in_scope") is False:
                continue
            kw = {f.name: r.get(f.name) for f in fields(Rule) if r.get(f.name) is not None}
            kw.setdefault("source", source)
            kw.setdefault("entity", entity)
            kw.setdefault("element", "*" if kw.get("level") == "dataset" else "")
            kw.setdefault("rule", "")
            kw.setdefault("rule_name", kw["rule"] or "(unnamed rule)")
            rule = Rule(**kw)
        else:
            raise TypeError(f"not a rule: {r!r}")
        if rule.is_active is None or int(rule.is_active) == 1:
            out.append(rule)
    owners = {(r.source, r.entity) for r in out}
    if len(owners) > 1:
        raise ValueError(f"rules of several entities {sorted(owners, key=str)[:5]}; select one source and entity first")
    return out


def _run_date_sql(run_ts) -> str:
    """The run stamp as ``timestamp_ntz``: fixed when ``run_ts`` is given, else the local now."""
    if run_ts is None:
        return "localtimestamp()"
    if isinstance(run_ts, _dt.datetime):
        run_ts = run_ts.isoformat(sep=" ")
    return f"CAST({str_lit(run_ts)} AS TIMESTAMP_NTZ)"


def _resolved(df: DataFrame, rules: Sequence[Rule]) -> list[tuple[Rule, str]]:
    """Pair each row rule with the table's own spelling of its element."""
    names = {f.name.lower(): f.name for f in df.schema.fields}
    out = []
    for r in rules:
        col = names.get(str(r.element).lower())
        if col is None:
            raise RuleError(r.rule_name, r.rule, f"no column {r.element!r} in {df.columns}")
        out.append((r, col))
    return out


def _rule_error(df: DataFrame, names: set[str], r: Rule) -> RuleError | None:
    """Why rule ``r`` cannot run on ``df`` (``None`` when it can)."""
    if not (r.rule or "").strip():
        return RuleError(r.rule_name, r.rule, "no rule text")
    try:
        parse_slo(r.slo)
    except ValueError as e:
        return RuleError(r.rule_name, r.rule, str(e))
    if r.is_aggregate:
        kind = (r.rule or "").strip().lower()
        if kind not in AGGREGATE_RULES:
            return RuleError(r.rule_name, r.rule, "unknown aggregate rule")
        if kind != "hassize" and str(r.element).lower() not in names:
            return RuleError(r.rule_name, r.rule, f"no column {r.element!r}")
        return None
    if str(r.element).lower() not in names:
        return RuleError(r.rule_name, r.rule, f"no column {r.element!r}")
    try:
        check_rules(df, [(r.rule_name, r.rule)])
    except RuleError as e:
        return e
    return None


def rule_errors(df: DataFrame, rules) -> list[RuleError]:
    """Every active rule that cannot run on ``df`` (unknown element or column, bad syntax,
    non-boolean or aggregate row rule, unknown aggregate rule, malformed SLO), analysed one
    by one on the driver (plan analysis only, no Spark job)."""
    names = {f.name.lower() for f in df.schema.fields}
    return [e for e in (_rule_error(df, names, r) for r in as_rules(rules)) if e is not None]


def rule_error_table(df: DataFrame, rules) -> DataFrame:
    """``rule_errors`` as a table ``(rule_name, rule, error)`` (one row per bad rule)."""
    rows = [(e.rule_name, e.rule, e.reason) for e in rule_errors(df, rules)]
    return df.sparkSession.createDataFrame(rows, "rule_name string, rule string, error string")


def _usable(df: DataFrame, rules, on_error: str) -> list[Rule]:
    # profiler rules name metrics, not row or aggregate rules: they belong to
    # profile_rule_metrics / checks_from_rules
    rs = [r for r in as_rules(rules) if r.kind != "profile"]
    if on_error == "raise":
        return rs
    if on_error != "skip":
        raise ValueError("on_error must be 'raise' or 'skip'")
    names = {f.name.lower() for f in df.schema.fields}
    return [r for r in rs if _rule_error(df, names, r) is None]


def _build(df: DataFrame, rules: Sequence[tuple[Rule, str]], make):
    """Build the plan; if analysis fails, analyse rule by rule to name the culprit."""
    try:
        return make()
    except RuleError:
        raise
    except Exception:  # noqa: BLE001 - diagnose below, re-raise if no rule is at fault
        check_rules(df, [(r.rule_name, r.rule) for r, _ in rules])
        raise


def row_results(
    df: DataFrame,
    rules,
    pass_through: Sequence[str] | None = None,
    run_ts=None,
    only_failures: bool = False,
    on_error: str = "raise",
) -> DataFrame:
    """One row per (input row, active row rule): value of the element and the rule's verdict.

    Output: ``pass_through...`` + ``rule_applied_on, source, entity, rule, rule_name,
    dimension, value (string), result (boolean, null when the rule is null), run_date``.
    One scan of ``df``: all rules are one ``inline(array(named_struct(...)))`` projection.
    ``only_failures`` keeps rows whose result is false. ``on_error='skip'`` leaves out rules
    that cannot run (see ``rule_errors``) instead of failing the batch.
    """
    rs = [r for r in _usable(df, rules, on_error) if not r.is_aggregate]
    if not rs:
        raise ValueError("no active row rules")
    compiled = _resolved(df, rs)
    structs = [
        "named_struct("
        f"'rule_applied_on', {str_lit(col)}, 'source', {str_lit(r.source)}, 'entity', {str_lit(r.entity)}, "
        f"'rule', {str_lit(r.rule)}, 'rule_name', {str_lit(r.rule_name)}, 'dimension', {str_lit(r.dimension)}, "
        f"'value', CAST({quote_ident(col)} AS STRING), 'result', {rule_sql(r.rule)})"
        for r, col in compiled
    ]
    reserved = {"rule_applied_on", "source", "entity", "rule", "rule_name", "dimension", "value", "result", "run_date"}
    clash = [c for c in (pass_through or []) if c.lower() in reserved]
    if clash:
        raise ValueError(f"pass-through columns {clash} clash with output columns; rename them first")
    keep = [quote_ident(resolve_name(df, c)) for c in (pass_through or [])]

    def make() -> DataFrame:
        items = f"array({', '.join(structs)})"
        if only_failures:  # dropped before the rows are made
            items = f"filter({items}, r -> r.result = false)"
        out = df.selectExpr(*keep, f"inline({items})", f"{_run_date_sql(run_ts)} AS run_date")
        bad = [f for f in out.schema.fields if f.name == "result" and not isinstance(f.dataType, T.BooleanType)]
        if bad:
            check_rules(df, [(r.rule_name, r.rule) for r, _ in compiled])
        return out

    return _build(df, compiled, make)


def _pack_units(units, limit: int) -> list[tuple[list[str], list[str]]]:
    """Blocks of (aggregate expressions, result structs) within the codegen field limit."""
    return [
        ([a for aggs, _, _ in group for a in aggs], [st for _, structs, _ in group for st in structs])
        for group in pack(units, lambda u: u[2], limit)
    ]


def rule_metrics(df: DataFrame, rules, on_error: str = "raise") -> DataFrame:
    """Per active rule: success / failure / row counts, pass percentage, SLO status.

    Row rules: success = rows where the rule is true, failure = rows where it is false
    (null counts in neither), count = all rows. Aggregate rules on the element:
    ``uniqueness`` = distinct non-null values / all rows, ``distinctness`` = distinct
    non-null values / non-null rows, ``completeness`` = non-null rows / all rows
    (failure = count - success); dataset rule ``hasSize`` tests the row count itself.
    ``pass_percentage`` is rounded half-up to 2 places; ``constraint_status`` applies the
    rule's ``slo`` (``gt|lt|eq|ge|le(n)``) and is null without one.
    Row rules share one aggregation (split into blocks only past the session's codegen
    field limit); the aggregate rules of a column share one two-level aggregation.
    ``on_error='skip'`` leaves out rules that cannot run (see ``rule_errors``).
    """
    rs = _usable(df, rules, on_error)
    if not rs:
        raise ValueError("no active rules")
    row_rules = _resolved(df, [r for r in rs if not r.is_aggregate])
    agg_rules = []
    for r in rs:
        if not r.is_aggregate:
            continue
        kind = (r.rule or "").strip().lower()
        if kind not in AGGREGATE_RULES:
            raise RuleError(r.rule_name, r.rule, f"unknown aggregate rule; use one of {', '.join(AGGREGATE_RULES)}")
        col = None if kind == "hassize" else _resolved(df, [r])[0][1]
        agg_rules.append((r, kind, col))

    def struct(r: Rule, applied_on: str, succ: str, total: str, on_size: bool, fail: str | None = None) -> str:
        try:
            slo = parse_slo(r.slo)
        except ValueError as e:
            raise RuleError(r.rule_name, r.rule, str(e)) from e
        return (
            "named_struct("
            f"'source', {str_lit(r.source)}, 'entity', {str_lit(r.entity)}, 'rule_applied_on', {str_lit(applied_on)}, "
            f"'rule', {str_lit(r.rule)}, 'rule_name', {str_lit(r.rule_name)}, 'dimension', {str_lit(r.dimension)}, "
            f"'slo_op', {str_lit(slo[0] if slo else None)}, "
            f"'slo_value', CAST({sql_literal(slo[1] if slo else None, 'DOUBLE')} AS DOUBLE), "
            f"'success_count', {succ}, 'failure_count', {fail or f'{total} - {succ}'}, 'count', {total}, "
            f"'on_size', {'TRUE' if on_size else 'FALSE'})"
        )

    # Units of work: (aggregate expressions, result structs, codegen field cost).
    row_units = []
    for i, (r, col) in enumerate(row_rules):
        # failures are the non-null results that are not true: null results count in neither
        row_units.append(
            ([f"count_if({rule_sql(r.rule)}) AS s{i}", f"count({rule_sql(r.rule)}) AS c{i}"],
             [struct(r, col, f"s{i}", "n", False, fail=f"c{i} - s{i}")], 4)
        )
    by_col: dict[str, list[tuple[Rule, str]]] = {}
    size_structs = []
    for r, kind, col in agg_rules:
        if kind == "hassize":
            size_structs.append(struct(r, r.element or "*", "n", "n", True))
        else:
            by_col.setdefault(col, []).append((r, kind))
    # Aggregate rules: one two-level aggregation per column (rows per value, then values), which
    # reads only that column; several count(DISTINCT) in one aggregation would multiply the rows.
    column_parts = []
    for col, items in by_col.items():
        made = {"uniqueness": ("d", "n"), "distinctness": ("d", "c"), "completeness": ("c", "n")}
        column_parts.append((col, [struct(r, col, *made[kind], False) for r, kind in items], {k for _, k in items} == {"completeness"}))
    # Row rules in blocks that fit the codegen field limit (pure hash aggregations); blocks
    # read only the columns their rules use.
    blocks = _pack_units(row_units, codegen_field_limit(df.sparkSession))
    if size_structs:
        if blocks:
            blocks[0] = (blocks[0][0], blocks[0][1] + size_structs)
        else:
            blocks = [([], size_structs)]

    pct = f"CASE WHEN NOT on_size THEN {pct_half_up_sql('success_count', 'count')} END"
    target = f"CASE WHEN on_size THEN CAST(count AS DOUBLE) ELSE ({pct}) END"
    status = " ".join(
        f"WHEN slo_op = '{op}' THEN {target} {sym} slo_value"
        for op, sym in (("gt", ">"), ("lt", "<"), ("eq", "="), ("ge", ">="), ("le", "<="))
    )

    def make() -> DataFrame:
        long = None
        for aggs, structs in blocks:
            part = df.selectExpr("count(1) AS n", *aggs).selectExpr(f"inline(array({', '.join(structs)}))")
            long = part if long is None else long.unionByName(part)
        for col, structs, counts_only in column_parts:
            v = quote_ident(col)
            if counts_only:
                one = df.selectExpr("count(1) AS n", f"count({v}) AS c", "0L AS d")
            else:
                per_value = df.groupBy(F.col(v).alias("v")).agg(F.count(F.lit(1)).alias("rows"))
                one = per_value.selectExpr(
                    "coalesce(sum(rows), 0L) AS n", "coalesce(sum(rows) FILTER (WHERE v IS NOT NULL), 0L) AS c", "count(v) AS d")
            part = one.selectExpr(f"inline(array({', '.join(structs)}))")
            long = part if long is None else long.unionByName(part)
        return long.selectExpr(
            "source", "entity", "rule_applied_on", "rule", "rule_name", "dimension", "success_count",
            "failure_count", "count", f"{pct} AS pass_percentage", f"CASE {status} END AS constraint_status",
        )

    return _build(df, row_rules, make)
