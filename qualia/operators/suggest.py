"""Constraint suggestion.

Suggestions come from the column profiles (``column_profiles``), and every rule is a Spark
expression over the profile rows (one row per column). Output: ``column_name, constraint,
current_value, description, predicate, code_for_constraint``; ``predicate`` is SQL text that
is true for conforming rows (null for constraints on a whole column).

Default rules (after Schelter et al., PVLDB 11(12), 2018; the cuts are arguments):

* ``complete``        completeness = 1                         -> isComplete
* ``retain_completeness`` ``least_completeness`` < completeness < 1 -> hasCompleteness(>= lower 95% bound,
  ``floor((p - 1.96 * sqrt(p (1 - p) / n)) * 100) / 100``)
* ``retain_type``     text column whose values all parse as one narrower type -> hasDataType
* ``categorical_range`` at most ``histogram_threshold`` bins and distinct non-null values /
  non-null rows <= ``categorical_ratio``                       -> isContainedIn(seen values)
* ``non_negative``    numeric column with minimum >= 0         -> isNonNegative
* ``unique``          complete, and as many distinct values as rows (exact) -> isUnique

On request: ``fractional_categorical_range``: a categorical column (as above) whose most frequent values, fewer than all,
cover ``coverage`` of the non-null rows -> isContainedIn(these values) for a share of at least the lower 95 % bound.

``evaluate_suggestions`` tests suggestions on rows they were not made from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualia.functions.predicates import qcol, quote_ident, sql_literal
from qualia.operators.metrics import Completeness, Compliance, MetricError, Uniqueness, metric_rows
from qualia.operators.profile import BOOLEAN_REGEX, DEFAULT_HISTOGRAM_THRESHOLD, FRACTIONAL_REGEX, INTEGRAL_REGEX, column_profiles

DEFAULT_RULES = ("complete", "retain_completeness", "retain_type", "categorical_range", "non_negative", "unique")
ALL_RULES = (*DEFAULT_RULES, "fractional_categorical_range")
Z_95 = 1.96


def _s(c: Column) -> Column:
    return c.cast("string")


def _escaped(c: Column, quote: str) -> Column:
    """Text between ``quote`` marks: backslashes and the mark are escaped by a backslash."""
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit(quote), F.lit("\\" + quote))


def suggest_constraints(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    rules: Sequence[str] = DEFAULT_RULES,
    histogram_threshold: int = DEFAULT_HISTOGRAM_THRESHOLD,
    categorical_ratio: float = 0.1,
    least_completeness: float = 0.2,
    coverage: float = 0.9,
) -> DataFrame:
    unknown = set(rules) - set(ALL_RULES)
    if unknown:
        raise ValueError(f"unknown suggestion rules {sorted(unknown)}")
    p = column_profiles(df, cols, histogram_threshold=histogram_threshold)
    col, comp, n = F.col("column_name"), F.col("completeness"), F.col("num_rows")
    q = F.concat(F.lit('"'), _escaped(col, '"'), F.lit('"'))
    sql = F.concat(F.lit("`"), F.replace(col, F.lit("`"), F.lit("``")), F.lit("`"))
    cands: list[Column] = []

    def cand(rule: str, cond: Column, constraint: str, current: Column, desc: Column, code: Column,
             predicate: Column | None = None) -> None:
        if rule in rules:
            cands.append(
                F.when(
                    cond,
                    F.struct(
                        F.lit(constraint).alias("constraint"),
                        current.alias("current_value"),
                        desc.alias("description"),
                        (F.lit(None).cast("string") if predicate is None else predicate).alias("predicate"),
                        code.alias("code_for_constraint"),
                    ),
                )
            )

    cand("complete", comp == 1.0, "isComplete", F.concat(F.lit("Completeness: "), _s(comp)),
         F.concat(F.lit("'"), col, F.lit("' is not null")), F.concat(F.lit(".isComplete("), q, F.lit(")")),
         F.concat(sql, F.lit(" IS NOT NULL")))
    target = F.floor((comp - F.lit(Z_95) * F.sqrt(comp * (F.lit(1.0) - comp) / n)) * 100) / F.lit(100.0)
    cand("retain_completeness", (comp > least_completeness) & (comp < 1.0), "hasCompleteness",
         F.concat(F.lit("Completeness: "), _s(comp)),
         F.concat(F.lit("'"), col, F.lit("' has completeness of at least "), _s(target)),
         F.concat(F.lit(".hasCompleteness("), q, F.lit(", lambda x: x >= "), _s(target), F.lit(")")))
    cand("retain_type", F.col("is_data_type_inferred") & F.col("data_type").isin("Integral", "Fractional", "Boolean"),
         "hasDataType", F.concat(F.lit("DataType: "), F.col("data_type")),
         F.concat(F.lit("'"), col, F.lit("' has type "), F.col("data_type")),
         F.concat(F.lit(".hasDataType("), q, F.lit(", ConstrainableDataTypes."), F.col("data_type"), F.lit(")")))
    values = F.transform(F.filter("histogram", lambda h: h["value"] != F.lit("NullValue")), lambda h: h["value"])
    distinct_nonnull = F.size(values)
    nonnull_rows = comp * n
    categorical = (
        F.col("histogram").isNotNull()
        & (distinct_nonnull > 0)
        & (distinct_nonnull.cast("double") <= F.lit(categorical_ratio) * nonnull_rows)
        & F.col("data_type").isin("String", "Integral", "Boolean")
    )
    quoted = F.transform(values, lambda v: F.concat(F.lit("'"), v, F.lit("'")))
    dquoted = F.transform(values, lambda v: F.concat(F.lit('"'), _escaped(v, '"'), F.lit('"')))
    squoted = F.transform(values, lambda v: F.concat(F.lit("'"), _escaped(v, "'"), F.lit("'")))
    cand("categorical_range", categorical, "isContainedIn", F.lit("Compliance: 1"),
         F.concat(F.lit("'"), col, F.lit("' has value range "), F.array_join(quoted, ", ")),
         F.concat(F.lit(".isContainedIn("), q, F.lit(", ["), F.array_join(dquoted, ", "), F.lit("])")),
         F.concat(sql, F.lit(" IS NULL OR "), sql, F.lit(" IN ("), F.array_join(squoted, ", "), F.lit(")")))
    seen = F.filter("histogram", lambda h: h["value"] != F.lit("NullValue"))
    before = lambda i: F.aggregate(F.slice(seen, 1, i), F.lit(0).cast("long"), lambda n_, h: n_ + h["count"])
    common = F.filter(seen, lambda h, i: before(i) < F.lit(coverage) * nonnull_rows)
    covered = F.aggregate(common, F.lit(0).cast("long"), lambda n_, h: n_ + h["count"]) / nonnull_rows
    share = F.floor((covered - F.lit(Z_95) * F.sqrt(covered * (F.lit(1.0) - covered) / nonnull_rows)) * 100) / F.lit(100.0)
    common = F.transform(common, lambda h: h["value"])
    top_quoted = F.array_join(F.transform(common, lambda v: F.concat(F.lit("'"), v, F.lit("'"))), ", ")
    top_double = F.array_join(F.transform(common, lambda v: F.concat(F.lit('"'), _escaped(v, '"'), F.lit('"'))), ", ")
    top_single = F.array_join(F.transform(common, lambda v: F.concat(F.lit("'"), _escaped(v, "'"), F.lit("'"))), ", ")
    cand("fractional_categorical_range", categorical & (F.size(common) < distinct_nonnull), "isContainedIn",
         F.concat(F.lit("Compliance: "), _s(F.round(covered, 4))),
         F.concat(F.lit("'"), col, F.lit("' has value range "), top_quoted, F.lit(" for at least "), _s(share), F.lit(" of values")),
         F.concat(F.lit(".isContainedIn("), q, F.lit(", ["), top_double, F.lit("], lambda x: x >= "), _s(share), F.lit(")")),
         F.concat(sql, F.lit(" IS NULL OR "), sql, F.lit(" IN ("), top_single, F.lit(")")))
    cand("non_negative", F.col("minimum") >= 0, "isNonNegative", F.concat(F.lit("Minimum: "), _s(F.col("minimum"))),
         F.concat(F.lit("'"), col, F.lit("' has no negative values")),
         F.concat(F.lit(".isNonNegative("), q, F.lit(")")), F.concat(sql, F.lit(" IS NULL OR "), sql, F.lit(" >= 0")))
    cand("unique", (n > 0) & (comp == 1.0) & (F.col("bins") == n), "isUnique",
         F.concat(F.lit("Distinctness: "), _s(F.col("bins") / n)),
         F.concat(F.lit("'"), col, F.lit("' is unique")), F.concat(F.lit(".isUnique("), q, F.lit(")")))
    if not cands:
        return p.sparkSession.createDataFrame(
            [], "column_name string, constraint string, current_value string, description string, "
            "predicate string, code_for_constraint string"
        )
    return p.select(col, F.inline(F.filter(F.array(*cands), lambda x: x.isNotNull())))


_TYPE_REGEX = {"Integral": INTEGRAL_REGEX, "Fractional": FRACTIONAL_REGEX, "Boolean": BOOLEAN_REGEX}


def _test_of(row, i: int):
    """The metric that tests a suggestion; it must reach ``least``."""
    least = float(row.code_for_constraint.rsplit("x >= ", 1)[1].rstrip(")")) if "lambda x: x >= " in row.code_for_constraint else 1.0
    if row.constraint == "hasCompleteness":
        return Completeness(row.column_name), least
    if row.constraint == "isUnique":
        return Uniqueness(row.column_name), least
    column = quote_ident(row.column_name)
    if row.constraint == "hasDataType":
        pattern = _TYPE_REGEX[row.current_value.split(": ", 1)[1]]
        return Compliance(f"suggestion {i}", f"{column} IS NULL OR {column} RLIKE {sql_literal(pattern)}"), least
    return Compliance(f"suggestion {i}", row.predicate), least


def evaluate_suggestions(
    df: DataFrame,
    holdout: float | str = 0.2,
    cols: Sequence[str] | None = None,
    **options,
) -> DataFrame:
    """Suggestions from one part of ``df``, each tested on the other: the columns of ``suggest_constraints`` and
    ``holdout_value`` (share of held-out rows that conform, completeness or uniqueness there), ``holdout_rows`` and
    ``holds`` (null without held-out rows).

    ``holdout`` is the share of rows that are held out, chosen by a hash of the whole row (equal rows stay together and a
    repeated run splits alike), or SQL text that is true for them. All suggestions are tested in the shared scans of
    ``run_metrics``; the suggestions (a few per column) are read on the driver to be compiled into that plan.
    """
    if isinstance(holdout, str):
        held = F.coalesce(F.expr(holdout), F.lit(False))
    elif 0 < holdout < 1:
        held = F.pmod(F.xxhash64(*[qcol(c) for c in df.columns]), F.lit(10_000)) < round(holdout * 10_000)
    else:
        raise ValueError("holdout is a share between 0 and 1 or SQL text")
    rows = suggest_constraints(df.where(~held), cols, **options)
    schema, found = rows.schema, rows.collect()
    rest = df.where(held)
    tests = [_test_of(r, i) for i, r in enumerate(found)]
    values, kept, failed = metric_rows(rest, [a for a, _ in tests])
    if failed:
        raise MetricError(*failed[0])
    place = {a: i for i, a in enumerate(kept)}
    told = df.sparkSession.createDataFrame(
        [(*r, place[a], least) for r, (a, least) in zip(found, tests)], ", ".join(
            [f"{f.name} {f.dataType.simpleString()}" for f in schema.fields] + ["metric_key int", "least double"]))
    size = rest.agg(F.count(F.lit(1)).alias("holdout_rows"))
    # a few rows per column on every side
    out = told.join(F.broadcast(values.select("metric_key", F.col("value").alias("holdout_value"))), "metric_key", "left")
    return out.join(F.broadcast(size)).select(
        *schema.names, "holdout_value", "holdout_rows", (F.col("holdout_value") >= F.col("least")).alias("holds"))
