"""Checks and verification.

A ``Check`` is a named list of constraints with a level (``Error`` or ``Warning``). A
verification run computes every metric the checks need ONCE (one scan-shared aggregation
plus one frequency aggregation, via ``metric_rows``), folds the few metric rows into a
single row, and evaluates every constraint's assertion there as a Spark expression; the
result table is one row per constraint. Nothing is collected to the driver.

Assertions are Column -> Column callables (``lambda v: v >= 15`` works as written),
``('ge', 8)`` pairs or ``'ge(8)'`` text.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualia.functions.predicates import as_assertion, quote_ident, sql_literal, str_lit
from qualia.operators.metrics import (
    Analyzer,
    Completeness,
    Compliance,
    CountDistinct,
    Distinctness,
    Size,
    Uniqueness,
    metric_rows,
)


class CheckLevel:
    Error = "Error"
    Warning = "Warning"


# Result labels and the failure message of the verification table.
SUCCESS, FAILURE = "Success", "Failure"
MESSAGE = "Value: {} does not meet the constraint requirement!"

CHECK_RESULT_COLUMNS = ["check", "check_level", "check_status", "constraint", "constraint_status", "constraint_message"]


@dataclass
class Constraint:
    analyzer: Analyzer
    assertion: Callable[[Column], Column]
    text: str
    hint: str | None = None
    integral: bool = False


def _opt(where: str | None) -> str:
    return f"Some({where})" if where else "None"


@dataclass
class Check:
    level: str
    description: str
    constraints: list[Constraint] = field(default_factory=list)

    def _add(self, c: Constraint) -> "Check":
        self.constraints.append(c)
        return self

    def has_size(self, assertion, hint: str | None = None, where: str | None = None) -> "Check":
        return self._add(
            Constraint(Size(where=where), as_assertion(assertion), f"SizeConstraint(Size({_opt(where)}))", hint, True)
        )

    def is_complete(self, column: str, hint: str | None = None, where: str | None = None) -> "Check":
        return self.has_completeness(column, lambda v: v == F.lit(1.0), hint, where)

    def has_completeness(self, column: str, assertion, hint: str | None = None, where: str | None = None) -> "Check":
        a = Completeness(column, where=where)
        return self._add(
            Constraint(a, as_assertion(assertion), f"CompletenessConstraint(Completeness({column},{_opt(where)}))", hint)
        )

    def is_unique(self, column, hint: str | None = None, where: str | None = None) -> "Check":
        return self.has_uniqueness(column, lambda v: v == F.lit(1.0), hint, where)

    def has_uniqueness(self, columns, assertion, hint: str | None = None, where: str | None = None) -> "Check":
        cols = [columns] if isinstance(columns, str) else list(columns)
        a = Uniqueness(cols, where=where)
        text = f"UniquenessConstraint(Uniqueness(List({', '.join(cols)}),{_opt(where)}))"
        return self._add(Constraint(a, as_assertion(assertion), text, hint))

    def has_distinctness(self, columns, assertion, hint: str | None = None, where: str | None = None) -> "Check":
        cols = [columns] if isinstance(columns, str) else list(columns)
        text = f"DistinctnessConstraint(Distinctness(List({', '.join(cols)}),{_opt(where)}))"
        return self._add(Constraint(Distinctness(cols, where=where), as_assertion(assertion), text, hint))

    def has_number_of_distinct_values(self, column: str, assertion, hint: str | None = None,
                                      where: str | None = None) -> "Check":
        text = f"CountDistinctConstraint(CountDistinct(List({column}),{_opt(where)}))"
        return self._add(Constraint(CountDistinct(column, where=where), as_assertion(assertion), text, hint, True))

    def is_non_negative(self, column: str, hint: str | None = None) -> "Check":
        q = quote_ident(column)
        return self.satisfies(f"COALESCE({q}, 0.0) >= 0", f"{column} is non-negative", lambda v: v == F.lit(1.0), hint)

    def has_data_type(self, column: str, data_type: str, assertion=None, hint: str | None = None) -> "Check":
        """Share of values (null counts as matching) whose text has ``data_type``
        (Integral, Fractional, Boolean, String), compared with ``assertion`` (default 1)."""
        from qualia.operators.profile import BOOLEAN_REGEX, FRACTIONAL_REGEX, INTEGRAL_REGEX

        name = str(data_type).split(".")[-1]
        patterns = {"Integral": INTEGRAL_REGEX, "Fractional": FRACTIONAL_REGEX, "Boolean": BOOLEAN_REGEX}
        q = f"CAST({quote_ident(column)} AS STRING)"
        pred = f"{q} IS NULL OR {q} RLIKE {sql_literal(patterns[name])}" if name in patterns else "TRUE"
        return self.satisfies(pred, f"{column} has type {name}", assertion, hint)

    def satisfies(self, predicate: str, label: str, assertion=None, hint: str | None = None,
                  where: str | None = None) -> "Check":
        a = Compliance(label, predicate, where=where)
        assertion = as_assertion(assertion) if assertion is not None else (lambda v: v == F.lit(1.0))
        text = f"ComplianceConstraint(Compliance({label},{predicate},{_opt(where)}))"
        return self._add(Constraint(a, assertion, text, hint))

    def is_contained_in(self, column: str, values: Sequence, hint: str | None = None) -> "Check":
        label = f"{column} contained in {','.join(str(v) for v in values)}"
        predicate = f"{quote_ident(column)} IS NULL OR {quote_ident(column)} IN ({','.join(sql_literal(v) for v in values)})"
        return self.satisfies(predicate, label, lambda v: v == F.lit(1.0), hint)

    # camelCase names, as callers of the metric library write them
    hasSize = has_size
    isComplete = is_complete
    hasCompleteness = has_completeness
    isUnique = is_unique
    hasUniqueness = has_uniqueness
    isContainedIn = is_contained_in
    hasDistinctness = has_distinctness
    isNonNegative = is_non_negative
    hasDataType = has_data_type
    hasNumberOfDistinctValues = has_number_of_distinct_values


def verify(df: DataFrame, checks: Sequence[Check], tags: Mapping[str, str] | None = None) -> DataFrame:
    """Check results: one row per constraint (``CHECK_RESULT_COLUMNS`` + ``tags``).

    ``constraint_status`` is Success when the assertion holds on the metric, else Failure
    (an undefined metric fails, and the message tells why it cannot be computed); ``constraint_message`` is empty on success, else
    ``Value: <v> does not meet the constraint requirement!`` followed by the hint;
    ``check_status`` is the check's level when any of its constraints fails, else Success.
    """
    analyzers = [c.analyzer for ch in checks for c in ch.constraints]
    if not analyzers:
        raise ValueError("no constraints to verify")
    rows, kept, failed = metric_rows(df, analyzers)
    reasons = dict(failed)
    index = {a: i for i, a in enumerate(kept)}
    needed = sorted({index[c.analyzer] for ch in checks for c in ch.constraints if c.analyzer in index})
    # Fold the handful of metric rows into one row: one column per metric.
    wide = rows.filter(F.col("metric_key") >= 0).agg(
        *[F.max(F.when(F.col("metric_key") == i, F.col("value"))).alias(f"v{i}") for i in needed],
        F.count(F.lit(1)).alias("_rows"),
    )
    # Assertions are Column callables: evaluate them all in one projection of the wide row.
    oks: dict[str, Column] = {}
    layout: list[tuple[Check, list[tuple[Constraint, str, str]]]] = []
    j = 0
    for ch in checks:
        items = []
        for c in ch.constraints:
            v = f"v{index[c.analyzer]}" if c.analyzer in index else None
            value = F.col(v) if v else F.lit(None).cast("double")
            oks[f"ok{j}"] = F.coalesce(c.assertion(value), F.lit(False))
            items.append((c, v or "CAST(NULL AS DOUBLE)", f"ok{j}"))
            j += 1
        layout.append((ch, items))
    evaluated = wide.withColumns(oks)
    structs = []
    for ch, items in layout:
        all_ok = " AND ".join(ok for _, _, ok in items) or "TRUE"
        check_status = f"CASE WHEN {all_ok} THEN {str_lit(SUCCESS)} ELSE {str_lit(ch.level)} END"
        for c, v, ok in items:
            shown = f"coalesce(CAST({'CAST(' + v + ' AS BIGINT)' if c.integral else v} AS STRING), 'null')"
            hint = f" {c.hint}" if c.hint else ""
            hint += f" ({reasons[c.analyzer]})" if c.analyzer in reasons else ""
            msg = f"concat('Value: ', {shown}, {str_lit(MESSAGE.split('{}')[1] + hint)})"
            structs.append(
                f"named_struct('check', {str_lit(ch.description)}, 'check_level', {str_lit(ch.level)}, "
                f"'check_status', {check_status}, 'constraint', {str_lit(c.text)}, "
                f"'constraint_status', CASE WHEN {ok} THEN {str_lit(SUCCESS)} ELSE {str_lit(FAILURE)} END, "
                f"'constraint_message', CASE WHEN {ok} THEN '' ELSE {msg} END)"
            )
    tag_cols = [f"{str_lit(v)} AS {quote_ident(k)}" for k, v in (tags or {}).items()]
    return evaluated.selectExpr(f"inline(array({', '.join(structs)}))", *tag_cols)


def checks_from_rules(rules, default_level: str = CheckLevel.Warning) -> list[Check]:
    """Checks from profiler rules and dataset-level rules of rule documents.

    One Check per ``(source, entity, check_level)`` (level default Warning), described as
    ``"<source>.<entity> <level>"``. Dimensions: Completeness (SLO, else complete),
    Distinctness and Uniqueness (SLO, else 1), CountDistinct (SLO required), Compliance
    (label ``dimension_instance`` or the rule name, predicate ``dimension_rule``; SLO,
    else 1); dataset ``hasSize`` (SLO required). The SLO text (``ge(0.9)``) is the assertion.
    """
    from qualia.operators.validate import as_rules

    one = lambda v: v == F.lit(1.0)
    checks: dict[tuple, Check] = {}
    for r in as_rules(rules):
        if r.kind not in (None, "profile") and r.level != "dataset":
            continue  # validation rules are run by rule_metrics
        kind = (r.rule_specification if r.level != "dataset" else r.rule) or ""
        dim = (r.dimension or kind or "").strip().lower()
        level = getattr(r, "check_level", None) or default_level
        key = (r.source, r.entity, level)
        ch = checks.setdefault(key, Check(level, f"{r.source}.{r.entity} {level}"))
        slo = r.slo
        if r.level == "dataset" or dim in ("size", "hassize"):
            if slo:  # without an objective the size is only measured
                ch.has_size(slo)
        elif dim == "completeness":
            ch.has_completeness(r.element, slo or one)
        elif dim == "distinctness":
            ch.has_distinctness(r.element, slo or one)
        elif dim == "uniqueness":
            ch.has_uniqueness(r.element, slo or one)
        elif dim in ("countdistinct", "count_distinct"):
            if slo:  # without an objective the count is only measured (profile_rule_metrics)
                ch.has_number_of_distinct_values(r.element, slo)
        elif dim == "compliance":
            ch.satisfies(r.rule, r.rule_name, slo or one)
        else:
            raise ValueError(f"rule {r.rule_name!r}: no check for dimension {r.dimension!r}")
    return list(checks.values())


class VerificationSuite:
    """Builder form: ``VerificationSuite().onData(df).addCheck(c).run()`` -> result table."""

    def __init__(self, df: DataFrame | None = None):
        self._df = df
        self._checks: list[Check] = []

    def onData(self, df: DataFrame) -> "VerificationSuite":  # noqa: N802
        self._df = df
        return self

    def addCheck(self, check: Check) -> "VerificationSuite":  # noqa: N802
        self._checks.append(check)
        return self

    on_data = onData
    add_check = addCheck

    def run(self, tags: Mapping[str, str] | None = None) -> DataFrame:
        if self._df is None:
            raise ValueError("no data: call onData(df) first")
        return verify(self._df, self._checks, tags)
