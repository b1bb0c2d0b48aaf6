"""Row results in one row per input row (Q3): rule verdicts as bitmaps.

``row_results`` makes rows x rules rows. ``packed_row_results`` makes one row per input row: the pass-through columns,
the text of each rule element once (``elements``), and two bitmaps over the rules in the order of ``PackedResults.rules``:
bit i of ``passed`` says that rule i is true, bit i of ``unknown`` that it is null (64 rules to a ``bigint``).
``unpack`` gives the rows of ``row_results`` back, for all rules or some; ``failures`` reads the bitmaps alone. It is one
projection: no shuffle, no row is multiplied, and what is stored shrinks with the number of rules.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualia.functions.predicates import quote_ident, resolve_name, rule_sql, str_lit
from qualia.operators.validate import Rule, _build, _resolved, _run_date_sql, _usable

_WORD = 64
_RESERVED = ("elements", "passed", "unknown")


@dataclass(frozen=True)
class PackedResults:
    """``rows`` (pass-through columns, elements, passed, unknown), and what its bits and elements stand for."""

    rows: DataFrame
    rules: tuple[Rule, ...]
    columns: tuple[str, ...]  # the element column of each rule
    elements: tuple[str, ...]  # the distinct element columns, in the order of ``elements``
    keep: tuple[str, ...]

    def _bit(self, bitmap: str, i: int) -> str:
        return f"(shiftrightunsigned({bitmap}[{i // _WORD}], {i % _WORD}) & 1L) = 1L"

    def verdict(self, i: int) -> Column:
        """Rule number ``i``: true, false or null."""
        return F.expr(f"IF({self._bit('unknown', i)}, NULL, {self._bit('passed', i)})")

    def unpack(self, rows: DataFrame | None = None, rule_names: Sequence[str] | None = None, run_ts=None) -> DataFrame:
        """The rows of ``row_results`` of ``rows`` (default: these; or the same columns read from storage)."""
        chosen = [i for i, r in enumerate(self.rules) if rule_names is None or r.rule_name in rule_names]
        if not chosen:
            raise ValueError(f"no rules {rule_names}")
        items = [
            "named_struct("
            f"'rule_applied_on', {str_lit(self.columns[i])}, 'source', {str_lit(r.source)}, 'entity', {str_lit(r.entity)}, "
            f"'rule', {str_lit(r.rule)}, 'rule_name', {str_lit(r.rule_name)}, 'dimension', {str_lit(r.dimension)}, "
            f"'value', elements[{self.elements.index(self.columns[i])}], "
            f"'result', IF({self._bit('unknown', i)}, NULL, {self._bit('passed', i)}))"
            for i in chosen for r in [self.rules[i]]
        ]
        return (self.rows if rows is None else rows).selectExpr(
            *[quote_ident(c) for c in self.keep], f"inline(array({', '.join(items)}))", f"{_run_date_sql(run_ts)} AS run_date")

    def failures(self, rows: DataFrame | None = None) -> DataFrame:
        """The packed rows in which a rule is false."""
        words = range((len(self.rules) + _WORD - 1) // _WORD)
        full = [(1 << min(_WORD, len(self.rules) - w * _WORD)) - 1 for w in words]
        false = " OR ".join(f"(passed[{w}] | unknown[{w}]) <> {_signed(full[w])}L" for w in words)
        return (self.rows if rows is None else rows).where(false)

    def false_counts(self, rows: DataFrame | None = None) -> DataFrame:
        """``rule_name, failure_count`` of every rule, from the bitmaps in one aggregation."""
        made = (self.rows if rows is None else rows).agg(
            *[F.count_if(~self.verdict(i)).alias(f"f{i}") for i in range(len(self.rules))])
        items = ", ".join(f"named_struct('rule_name', {str_lit(r.rule_name)}, 'failure_count', f{i})" for i, r in enumerate(self.rules))
        return made.selectExpr(f"inline(array({items}))")


def _signed(word: int) -> int:
    return word - (1 << _WORD) if word >> (_WORD - 1) else word


def packed_row_results(df: DataFrame, rules, pass_through: Sequence[str] | None = None, on_error: str = "raise") -> PackedResults:
    """One row per row of ``df`` with the verdicts of all active row rules."""
    rs = [r for r in _usable(df, rules, on_error) if not r.is_aggregate]
    if not rs:
        raise ValueError("no active row rules")
    keep = [resolve_name(df, c) for c in (pass_through or [])]
    clash = [c for c in keep if c.lower() in _RESERVED]
    if clash:
        raise ValueError(f"pass-through columns {clash} clash with output columns; rename them first")
    compiled = _resolved(df, rs)
    elements = list(dict.fromkeys(c for _, c in compiled))

    def word(test: str) -> str:
        words = []
        for start in range(0, len(compiled), _WORD):
            bits = [f"IF({test.format(rule_sql(r.rule))}, {_signed(1 << i)}L, 0L)" if _signed(1 << i) >= 0
                    else f"IF({test.format(rule_sql(r.rule))}, shiftleft(1L, 63), 0L)" for i, (r, _) in enumerate(compiled[start:start + _WORD])]
            words.append(" | ".join(bits))
        return f"array({', '.join(words)})"

    def make() -> DataFrame:
        return df.selectExpr(
            *[quote_ident(c) for c in keep],
            f"array({', '.join(f'CAST({quote_ident(c)} AS STRING)' for c in elements)}) AS elements",
            f"{word('coalesce({0}, FALSE)')} AS passed", f"{word('({0}) IS NULL')} AS unknown")

    return PackedResults(_build(df, compiled, make), tuple(rs), tuple(c for _, c in compiled), tuple(elements), tuple(keep))
