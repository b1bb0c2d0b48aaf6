"""Quality metrics (M1-M12) and the runner that shares scans between them.

Each analyzer yields metric rows ``(entity, instance, name, value double)``:

* scan-shareable analyzers (Size, Completeness, Compliance, lengths, numeric statistics,
  approximate distinct count) become expressions of one ``agg`` over the table (packed
  into blocks that fit the session's codegen field limit; sketches apart);
* grouping analyzers (Distinctness, Uniqueness, CountDistinct, Histogram) share ONE
  frequency table for all their key sets (see ``frequencies``).

Definitions (checked against the recorded library output):
Completeness = non-null rows / rows; Distinctness = distinct non-null values / non-null
rows; Uniqueness = values seen exactly once / non-null rows (a multi-column row counts
when any key part is non-null); Compliance = rows where the predicate is true / rows
(null is not compliant); Histogram ratio = value rows / all rows, null shown as
``NullValue`` and counted as a bin. A metric whose value is undefined (no rows) is left out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualia.functions.predicates import COMPLEX_TYPES, field_type, is_numeric, qcol, ratio, resolve_name, str_lit
from qualia.operators.frequencies import frequencies, key_set_stats, key_set_table
from qualia.functions.blocks import codegen_field_limit, pack

METRIC_SCHEMA = "entity string, instance string, name string, value double"

# Entity labels and the label of the null bin in histograms.
DATASET, COLUMN, MULTICOLUMN = "Dataset", "Column", "Multicolumn"
NULL_BIN = "NullValue"


def _named(name: str, where: str | None) -> str:
    return f"{name} (where: {where})" if where else name


def _cond(where: str | None) -> Column:
    return F.expr(where) if where else F.lit(True)


@dataclass(frozen=True)
class Analyzer:
    """Base: subclasses define ``name`` and either ``scan_value`` or a frequency key set."""

    where: str | None = None

    name = ""
    grouping = False
    # aggregation buffer slots + 1 output column: sizes blocks to the codegen field limit
    cost = 2
    # imperative aggregates (sketches) run outside whole-stage codegen: keep them apart
    imperative = False

    def entity_instance(self) -> tuple[str, str]:
        return DATASET, "*"

    def metric_name(self) -> str:
        return _named(self.name, self.where)


@dataclass(frozen=True)
class Size(Analyzer):
    name = "Size"
    cost = 2

    def scan_value(self, df: DataFrame) -> Column:
        return F.count_if(_cond(self.where)).cast("double")


@dataclass(frozen=True)
class _ColumnAnalyzer(Analyzer):
    column: str = ""

    def __init__(self, column: str, where: str | None = None):
        object.__setattr__(self, "column", column)
        object.__setattr__(self, "where", where)

    def entity_instance(self) -> tuple[str, str]:
        return COLUMN, self.column


@dataclass(frozen=True, init=False)
class Completeness(_ColumnAnalyzer):
    name = "Completeness"
    cost = 3

    def scan_value(self, df: DataFrame) -> Column:
        c = qcol(resolve_name(df, self.column))
        w = _cond(self.where)
        return ratio(F.count_if(w & c.isNotNull()), F.count_if(w))


@dataclass(frozen=True, init=False)
class MaxLength(_ColumnAnalyzer):
    name = "MaxLength"

    def scan_value(self, df: DataFrame) -> Column:
        c = resolve_name(df, self.column)
        if not isinstance(field_type(df, c), T.StringType):
            raise TypeError(f"{self.name} needs a string column, {c} is {field_type(df, c).simpleString()}")
        return F.max(F.when(_cond(self.where), F.length(qcol(c)))).cast("double")


@dataclass(frozen=True, init=False)
class MinLength(_ColumnAnalyzer):
    name = "MinLength"

    def scan_value(self, df: DataFrame) -> Column:
        c = resolve_name(df, self.column)
        if not isinstance(field_type(df, c), T.StringType):
            raise TypeError(f"{self.name} needs a string column, {c} is {field_type(df, c).simpleString()}")
        return F.min(F.when(_cond(self.where), F.length(qcol(c)))).cast("double")


@dataclass(frozen=True, init=False)
class _Numeric(_ColumnAnalyzer):
    fn = None

    def scan_value(self, df: DataFrame) -> Column:
        c = resolve_name(df, self.column)
        if not is_numeric(field_type(df, c)):
            raise TypeError(f"{self.name} needs a numeric column, {c} is {field_type(df, c).simpleString()}")
        v = qcol(c).cast("double")
        v = F.when(v == 0, F.lit(0.0)).otherwise(v)  # -0.0 reads as 0.0
        return type(self).fn(F.when(_cond(self.where), v))


@dataclass(frozen=True, init=False)
class Mean(_Numeric):
    name = "Mean"
    cost = 3
    fn = staticmethod(F.avg)


@dataclass(frozen=True, init=False)
class Sum(_Numeric):
    name = "Sum"
    fn = staticmethod(F.sum)


@dataclass(frozen=True, init=False)
class StandardDeviation(_Numeric):
    """Population standard deviation."""

    name = "StandardDeviation"
    cost = 4
    fn = staticmethod(F.stddev_pop)


@dataclass(frozen=True, init=False)
class Minimum(_Numeric):
    name = "Minimum"
    fn = staticmethod(F.min)


@dataclass(frozen=True, init=False)
class Maximum(_Numeric):
    name = "Maximum"
    fn = staticmethod(F.max)


@dataclass(frozen=True, init=False)
class ApproxCountDistinct(_ColumnAnalyzer):
    name = "ApproxCountDistinct"
    imperative = True
    cost = 60

    def scan_value(self, df: DataFrame) -> Column:
        c = qcol(resolve_name(df, self.column))
        return F.approx_count_distinct(F.when(_cond(self.where), c)).cast("double")


@dataclass(frozen=True, init=False)
class Compliance(Analyzer):
    instance: str = ""
    predicate: str = ""

    name = "Compliance"
    cost = 3

    def __init__(self, instance: str, predicate: str, where: str | None = None):
        object.__setattr__(self, "instance", instance)
        object.__setattr__(self, "predicate", predicate)
        object.__setattr__(self, "where", where)

    def entity_instance(self) -> tuple[str, str]:
        return COLUMN, self.instance

    def scan_value(self, df: DataFrame) -> Column:
        w = _cond(self.where)
        return ratio(F.count_if(w & F.expr(self.predicate)), F.count_if(w))


@dataclass(frozen=True, init=False)
class _Grouping(Analyzer):
    columns: tuple = ()

    grouping = True

    def __init__(self, columns, where: str | None = None):
        cols = (columns,) if isinstance(columns, str) else tuple(columns)
        object.__setattr__(self, "columns", cols)
        object.__setattr__(self, "where", where)

    def entity_instance(self) -> tuple[str, str]:
        if len(self.columns) == 1:
            return COLUMN, self.columns[0]
        return MULTICOLUMN, ",".join(self.columns)

    def key(self, df: DataFrame):
        cols = tuple(resolve_name(df, c) for c in self.columns)
        for c in cols:
            if isinstance(field_type(df, c), COMPLEX_TYPES):
                raise TypeError(f"column {c!r} has a complex type")
        return cols, self.where


@dataclass(frozen=True, init=False)
class Distinctness(_Grouping):
    name = "Distinctness"

    def from_stats(self, st) -> Column:
        return ratio(st("distinct_nonnull"), st("nonnull_rows"))


@dataclass(frozen=True, init=False)
class Uniqueness(_Grouping):
    name = "Uniqueness"

    def from_stats(self, st) -> Column:
        return ratio(st("unique_nonnull"), st("nonnull_rows"))


@dataclass(frozen=True, init=False)
class CountDistinct(_Grouping):
    name = "CountDistinct"

    def from_stats(self, st) -> Column:
        return st("distinct_nonnull").cast("double")


@dataclass(frozen=True, init=False)
class Histogram(_Grouping):
    """``Histogram.bins`` plus ``Histogram.abs.<v>`` / ``Histogram.ratio.<v>`` per value."""

    name = "Histogram"

    def from_stats(self, st) -> Column:
        return st("bins").cast("double")

    def metric_name(self) -> str:
        return _named("Histogram.bins", self.where)


# Registry for metric names used in configuration documents (lower-case keys).
ANALYZERS = {
    "size": Size,
    "completeness": Completeness,
    "distinctness": Distinctness,
    "uniqueness": Uniqueness,
    "countdistinct": CountDistinct,
    "count_distinct": CountDistinct,
    "compliance": Compliance,
    "max_length": MaxLength,
    "maxlength": MaxLength,
    "min_length": MinLength,
    "minlength": MinLength,
    "mean": Mean,
    "sum": Sum,
    "standarddeviation": StandardDeviation,
    "stddev": StandardDeviation,
    "minimum": Minimum,
    "maximum": Maximum,
    "approxcountdistinct": ApproxCountDistinct,
    "histogram": Histogram,
}


def analyzer_for(name: str, column: str, where: str | None = None) -> Analyzer:
    key = name.strip().lower().replace(" ", "")
    if key not in ANALYZERS:
        raise KeyError(f"unknown metric {name!r}; known: {sorted(ANALYZERS)}")
    cls = ANALYZERS[key]
    if cls is Size:
        return Size(where=where)
    if cls is Compliance:
        raise ValueError("compliance needs a label and a predicate: use Compliance(label, predicate)")
    return cls(column, where=where)


def _meta(a: Analyzer, value: Column, key: int = -1) -> Column:
    entity, instance = a.entity_instance()
    return F.struct(
        F.lit(entity).alias("entity"),
        F.lit(instance).alias("instance"),
        F.lit(a.metric_name()).alias("name"),
        value.cast("double").alias("value"),
        F.lit(key).alias("metric_key"),
    )


class MetricError(ValueError):
    """A metric that cannot be computed on a table."""

    def __init__(self, analyzer: Analyzer, reason: str):
        self.analyzer, self.reason = analyzer, reason
        entity, instance = analyzer.entity_instance()
        super().__init__(f"{analyzer.metric_name()} of {entity} {instance!r}: {reason}")


def _reason(e: Exception) -> str:
    """First line of an analysis error, without the error class and the query context."""
    return str(e.args[0] if isinstance(e, KeyError) and e.args else e).strip().splitlines()[0]


def _failure(df: DataFrame, a: Analyzer) -> str | None:
    """Why metric ``a`` cannot be computed on ``df`` (plan analysis only, no job)."""
    try:
        if a.grouping:
            a.key(df)
            if a.where:
                df.filter(a.where).schema  # noqa: B018 - analysis only
        else:
            df.agg(a.scan_value(df)).schema  # noqa: B018
    except (KeyError, TypeError, ValueError, PySparkException) as e:
        return _reason(e)
    return None


def _split(df: DataFrame, analyzers: Sequence[Analyzer]) -> tuple[list[Analyzer], list[tuple[Analyzer, str]]]:
    """Distinct analyzers that can run, and the others with the reason. One analysis for all
    scan metrics, then one per metric only if that fails."""
    distinct = list(dict.fromkeys(analyzers))
    scan = [a for a in distinct if not a.grouping]
    try:
        df.agg(*[a.scan_value(df) for a in scan] or [F.count(F.lit(1))]).schema  # noqa: B018
        sure = set(scan)
    except (KeyError, TypeError, ValueError, PySparkException):
        sure = set()
    failures = {a: None if a in sure else _failure(df, a) for a in distinct}
    return [a for a in distinct if failures[a] is None], [(a, r) for a, r in failures.items() if r is not None]


def metric_errors(df: DataFrame, analyzers: Sequence[Analyzer]) -> DataFrame:
    """``entity, instance, name, error`` of the metrics that cannot be computed on ``df``."""
    rows = [(*a.entity_instance(), a.metric_name(), reason) for a, reason in _split(df, analyzers)[1]]
    return df.sparkSession.createDataFrame(rows, "entity string, instance string, name string, error string")


def run_metrics(df: DataFrame, analyzers: Sequence[Analyzer], on_error: str = "raise") -> DataFrame:
    """Compute all analyzers with as few scans as possible; long table of metric rows.

    One ``agg`` for scan analyzers, one frequency aggregation for all grouping analyzers
    (plus a per-value branch for histograms). Every requested metric has its row: undefined
    values (no rows, NaN input) stay as null or NaN. A metric that cannot be computed (no
    such column, wrong type) raises ``MetricError``; with ``on_error='report'`` it has a row
    with a null value, and the column ``error`` tells why.
    """
    if on_error not in ("raise", "report"):
        raise ValueError("on_error must be 'raise' or 'report'")
    out, _, failed = metric_rows(df, analyzers)
    out = out.drop("metric_key")
    if on_error == "raise":
        if failed:
            raise MetricError(*failed[0])
        return out
    errors = metric_errors(df, [a for a, _ in failed])
    return out.withColumn("error", F.lit(None).cast("string")).unionByName(
        errors.select("entity", "instance", "name", F.lit(None).cast("double").alias("value"), "error"))


def _meta_sql(a: Analyzer, value_col: str, key: int) -> str:
    entity, instance = a.entity_instance()
    return (
        f"named_struct('entity', {str_lit(entity)}, 'instance', {str_lit(instance)}, 'name', "
        f"{str_lit(a.metric_name())}, 'value', CAST({value_col} AS DOUBLE), 'metric_key', {key})"
    )


def metric_rows(
    df: DataFrame, analyzers: Sequence[Analyzer]
) -> tuple[DataFrame, list[Analyzer], list[tuple[Analyzer, str]]]:
    """Metric rows with a ``metric_key`` column: the position of the analyzer in the
    returned list of distinct, computable analyzers (histogram value rows get -1); last the
    analyzers that cannot be computed, with the reason."""
    kept, failed = _split(df, analyzers)
    scan = [(i, a, a.scan_value(df)) for i, a in enumerate(kept) if not a.grouping]
    groups: dict[tuple, int] = {}
    grouped = [(i, a, groups.setdefault(a.key(df), len(groups))) for i, a in enumerate(kept) if a.grouping]
    parts: list[DataFrame] = []
    if scan:
        # Blocks that fit the codegen field limit; sketch aggregates in blocks of their own.
        limit = codegen_field_limit(df.sparkSession)
        plain = [j for j, (_, a, _) in enumerate(scan) if not a.imperative]
        sketches = [j for j, (_, a, _) in enumerate(scan) if a.imperative]
        cost = lambda j: scan[j][1].cost
        blocks = pack(plain, cost, limit) + pack(sketches, cost, limit)
        for block in blocks:
            wide = df.agg(*[scan[j][2].alias(f"m{j}") for j in block])
            metas = ", ".join(_meta_sql(scan[j][1], f"m{j}", scan[j][0]) for j in block)
            parts.append(wide.selectExpr(f"inline(array({metas}))"))
    if grouped:
        keys = list(groups)
        freq = frequencies(df, [cols for cols, _ in keys], [w for _, w in keys])
        # Per-key-set statistics, one row per key set (zeros for key sets without rows, so
        # metrics of an empty table are defined: CountDistinct 0, ratios null). Histograms
        # take their bins and totals from their own branch; every branch reads the same
        # counted frequency table, so Spark runs its scan and shuffle once (reused exchange).
        plain = [(i, a, k) for i, a, k in grouped if not isinstance(a, Histogram)]
        if plain:
            stats = key_set_table(freq, len(keys))
            structs = [F.when(F.col("k") == k, _meta(a, a.from_stats(F.col), key=i)) for i, a, k in plain]
            parts.append(stats.select(F.inline(F.filter(F.array(*structs), lambda x: x.isNotNull()))))
        hist = [(i, a, k) for i, a, k in grouped if isinstance(a, Histogram)]
        if hist:
            parts += _histogram_rows(freq, hist)
    if not parts:  # every metric failed: an empty metric table
        return df.sparkSession.createDataFrame([], METRIC_SCHEMA + ", metric_key int"), kept, failed
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, kept, failed


def _histogram_rows(freq: DataFrame, hist: list[tuple[int, "Histogram", int]]) -> list[DataFrame]:
    """``Histogram.bins`` per key set, then absolute count and ratio (over all rows of the
    key set) per value. The per-key-set totals have one row per key set (a bound set by
    the caller's metric list) and are broadcast; the frequency side is never collected."""
    totals = key_set_stats(freq).select("k", "rows", "bins")
    # `bins` guarded by `rows` (never negative): this branch then needs the counted
    # frequency table like the others, instead of a pruned copy with a shuffle of its own.
    bins_value = F.when(F.col("rows") >= 0, F.col("bins"))
    bins = totals.select(
        F.inline(F.filter(F.array(*[F.when(F.col("k") == k, _meta(a, bins_value, key=i)) for i, a, k in hist]),
                          lambda x: x.isNotNull()))
    )
    # No filter on k: it would be pushed below the frequency aggregation and change that
    # subtree, so Spark could no longer reuse the one frequency shuffle.
    # Null-safe left join on k (every key set has a total; k is never null): an ordinary
    # equi-join would infer `k IS NOT NULL` filters that Catalyst pushes below the frequency
    # aggregation, changing that subtree so its shuffle could not be reused.
    t = totals.select(F.col("k").alias("tk"), "rows")
    f = freq.join(F.broadcast(t), freq["k"].eqNullSafe(t["tk"]), "left").drop("tk")
    label = F.coalesce(F.col("v"), F.lit(NULL_BIN))
    rows = []
    for _, a, k in hist:
        entity, instance = a.entity_instance()
        suffix = f" (where: {a.where})" if a.where else ""
        for kind, value in (("abs", F.col("n").cast("double")), ("ratio", ratio(F.col("n"), F.col("rows")))):
            rows.append(
                F.when(
                    F.col("k") == k,
                    F.struct(
                        F.lit(entity).alias("entity"),
                        F.lit(instance).alias("instance"),
                        F.concat(F.lit(f"Histogram.{kind}."), label, F.lit(suffix)).alias("name"),
                        value.alias("value"),
                        F.lit(-1).alias("metric_key"),
                    ),
                )
            )
    return [bins, f.select(F.inline(F.filter(F.array(*rows), lambda x: x.isNotNull())))]


def metrics_from_config(df: DataFrame, config, on_error: str = "report") -> DataFrame:
    """Metrics chosen by configuration ``[{rule_name, on_columns[]}]`` or a
    ``(rule_name, column)`` DataFrame. Every requested metric has a row; ``error`` tells why a
    metric has no value (see ``run_metrics``). The configuration is compiled into the plan, so
    it is read on the driver: it lists metric names, not data."""
    if isinstance(config, DataFrame):
        pairs = [(r["rule_name"], r["column"]) for r in config.select("rule_name", "column").distinct().toLocalIterator()]
    else:
        pairs = [(c["rule_name"], col) for c in config for col in (c.get("on_columns") or [])]
    return run_metrics(df, [analyzer_for(n, c) for n, c in pairs], on_error)


def profile_rule_metrics(df: DataFrame, rules) -> DataFrame:
    """M12 from rule documents: the metric each profiler rule names (``dimension`` on its
    element; Compliance uses the rule name as label and ``dimension_rule`` as predicate)."""
    from qualia.operators.validate import as_rules

    analyzers = []
    for r in as_rules(rules):
        if r.kind not in (None, "profile") and r.level != "dataset":
            continue  # validation rules are run by rule_metrics
        if r.level == "dataset":
            analyzers.append(Size())
            continue
        dim = (r.dimension or "").strip()
        if dim.lower() == "compliance":
            analyzers.append(Compliance(r.rule_name, r.rule))
        else:
            analyzers.append(analyzer_for(dim, r.element))
    return run_metrics(df, analyzers)
