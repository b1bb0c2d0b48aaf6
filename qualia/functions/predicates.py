"""Column-level building blocks shared by every operator.

All helpers return ``pyspark.sql.Column`` expressions built from native Spark
functions, so they stay inside whole-stage codegen; none of them runs Python per row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Threshold operator names used in rule and check documents
# ("gt(90)", "ge(0.9)", ...), in the order the documents use them.
SLO_OPS = ("gt", "lt", "eq", "ge", "le")
SLO_REGEX = r"^\s*(gt|lt|eq|ge|le)\s*\(\s*([-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?)\s*\)\s*$"

# The whitespace-only pattern and the date-time pattern of the checks.
SPACES_REGEX = r"^\s+$"
FULL_TIMESTAMP_REGEX = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2})$"

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
FLOATING_TYPES = (T.FloatType, T.DoubleType)
COMPLEX_TYPES = (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.BinaryType)


class RuleError(ValueError):
    """A rule's SQL text does not compile against the table, or is not boolean."""

    def __init__(self, rule_name: str, rule: str, reason: str):
        super().__init__(f"rule {rule_name!r} ({rule!r}): {reason}")
        self.rule_name = rule_name
        self.rule = rule
        self.reason = reason


# ---------------------------------------------------------------- thresholds


def parse_slo(text: str | None) -> tuple[str, float] | None:
    """``'gt(90)'`` -> ``('gt', 90.0)``; ``None``/empty -> ``None``."""
    if text is None or str(text).strip() == "":
        return None
    m = re.match(SLO_REGEX, str(text))
    if not m:
        raise ValueError(f"threshold {text!r} is not one of {', '.join(o + '(n)' for o in SLO_OPS)}")
    return m.group(1), float(m.group(2))


def compare(value: Column, op: str, bound: float | Column) -> Column:
    """``value <op> bound`` for one of gt, lt, eq, ge, le (null stays null)."""
    b = bound if isinstance(bound, Column) else F.lit(bound)
    if op == "gt":
        return value > b
    if op == "lt":
        return value < b
    if op == "eq":
        return value == b
    if op == "ge":
        return value >= b
    if op == "le":
        return value <= b
    raise ValueError(f"unknown threshold operator {op!r}")



def slo_parts(text: Column) -> tuple[Column, Column]:
    """Split a threshold text column into (op, bound) columns; unparsable -> null."""
    op = F.nullif(F.regexp_extract(text, SLO_REGEX, 1), F.lit(""))
    bound = F.nullif(F.regexp_extract(text, SLO_REGEX, 2), F.lit("")).try_cast("double")
    return op, bound


def _threshold(op: str) -> Callable[[float], Callable[[Column], Column]]:
    def make(n: float) -> Callable[[Column], Column]:
        fn = lambda v: compare(v, op, n)
        fn.op, fn.bound = op, n  # type: ignore[attr-defined]
        return fn

    make.__name__ = op
    return make


gt = _threshold("gt")
lt = _threshold("lt")
eq = _threshold("eq")
ge = _threshold("ge")
le = _threshold("le")


def as_assertion(a) -> Callable[[Column], Column]:
    """Accept a Column->Column callable, ``('ge', 8)``, or text ``'ge(8)'``."""
    if a is None:
        return lambda v: F.lit(True)
    if callable(a):
        return a
    if isinstance(a, str):
        op, bound = parse_slo(a)
        return _threshold(op)(bound)
    if isinstance(a, (tuple, list)) and len(a) == 2:
        return _threshold(a[0])(float(a[1]))
    raise TypeError(f"cannot use {a!r} as an assertion")


# ---------------------------------------------------------------- arithmetic


def pct_half_up_sql(success: str, total: str) -> str:
    """SQL for ``round(success / total * 100, 2)`` rounded half-up on the exact ratio.

    Takes column names and uses exact long ``div``, so ties do not depend on
    floating-point rounding; null when ``total`` is 0.
    """
    s, n = quote_ident(success), quote_ident(total)
    return f"CASE WHEN {n} > 0 THEN ((20000 * {s} + {n}) div (2 * {n})) / 100.0D END"


def pct_half_up(success: str, total: str) -> Column:
    """``pct_half_up_sql`` as a Column."""
    return F.expr(pct_half_up_sql(success, total))


def ratio(num: Column, den: Column) -> Column:
    """Double ratio, null when the denominator is 0 (no ANSI divide-by-zero error)."""
    return F.when(den != 0, num.cast("double") / den.cast("double"))


# ---------------------------------------------------------------- predicates



def rule_sql(text: str) -> str:
    """A rule's SQL text ready to splice into a larger expression: parenthesised, and ended
    by a newline so a trailing ``--`` comment cannot swallow what follows."""
    return f"({text}\n)"


def check_rules(df: DataFrame, rules: Sequence[tuple[str, str]]) -> None:
    """Analyse every ``(rule_name, rule_text)`` against ``df`` as it is used (a boolean
    row predicate inside ``count_if``); raise ``RuleError`` naming the first bad rule.

    Analysis runs on the driver over the plan only (no job). One projection is tried for
    all rules; on failure each rule is analysed alone to report the culprit. Unknown
    columns, bad syntax, non-boolean results and aggregate functions are all caught.
    """
    if not rules:
        return
    try:
        df.selectExpr(*[f"count_if({rule_sql(r)}) AS _r{i}" for i, (_, r) in enumerate(rules)]).schema
        return
    except Exception:  # noqa: BLE001 - fall back to one rule at a time
        pass
    for name, text in rules:
        try:
            df.selectExpr(f"count_if({rule_sql(text)})").schema
        except Exception as e:  # noqa: BLE001
            raise RuleError(name, text, str(e).splitlines()[0]) from e


def field_type(df: DataFrame, name: str) -> T.DataType:
    """Case-insensitive column type lookup."""
    low = name.lower()
    for f in df.schema.fields:
        if f.name.lower() == low:
            return f.dataType
    raise KeyError(f"no column {name!r} in {df.columns}")


def resolve_name(df: DataFrame, name: str) -> str:
    """The table's own spelling of a column named case-insensitively."""
    low = name.lower()
    for f in df.schema.fields:
        if f.name.lower() == low:
            return f.name
    raise KeyError(f"no column {name!r} in {df.columns}")


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)





def matches(c: Column, pattern: str) -> Column:
    """Regex predicate (Java regex, partial match unless anchored)."""
    return c.rlike(pattern)


def format_check(c: Column, fmt: str) -> Column:
    """True when the text parses with the datetime pattern ``fmt``; false otherwise; null stays null."""
    text = c.cast("string")
    return F.when(text.isNotNull(), F.try_to_timestamp(text, F.lit(fmt)).isNotNull())



def as_text(c: Column, dt: T.DataType) -> Column:
    """Value as string for frequency keys; -0.0 folded into 0.0 so grouping matches typed grouping."""
    if isinstance(dt, FLOATING_TYPES):
        c = F.when(c == 0, F.lit(0.0).cast(dt)).otherwise(c)
    return c.cast("string")


def sql_literal(v, type_name: str | None = None) -> str:
    """Render a Python value as a Spark SQL literal (strings single-quoted, ``\\`` and ``'``
    backslash-escaped as the Spark parser expects). ``None`` becomes a typed null when
    ``type_name`` is given."""
    if v is None:
        return f"CAST(NULL AS {type_name})" if type_name else "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return f"{v}L" if abs(v) > 2**31 - 1 else str(v)
    if isinstance(v, float):
        if v != v or v in (float("inf"), float("-inf")):
            return f"double('{v}')"
        return f"{v!r}D"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def str_lit(v) -> str:
    """String literal (typed null for ``None``)."""
    return sql_literal(None if v is None else str(v), "STRING")


def qcol(name: str) -> Column:
    """Column by exact name, quoted so dots or spaces in the name are not read as paths."""
    return F.col(quote_ident(name))


def quote_ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
