"""Mergeable metric states (M10, M11): metrics of a grown table from the states of its parts.

A *state* is what a part of a table (a batch, a day, a file) contributes to a metric, in a form that
merges: row counts, moments (count, sum, squared deviations), extremes, HyperLogLog and KLL sketches,
and, for grouping metrics, the part's count of each key value. ``metric_states`` computes the states of
one part in shared scans, ``merge_states`` merges the states of any parts, and ``metrics_from_states``
gives the rows ``run_metrics`` gives over the whole table, without reading it. States are stored in a
table partitioned by part (``save_states``): a part that is computed again replaces its own rows, and
``compact_states`` merges parts into one.

One row per state (grouping metrics: per state and key value):
``part, state, key, nn, n, total, spread, low, high, sketch``; ``state`` is a JSON text of kind,
columns and filter, so equal states of different metrics are computed and stored once.

Merging: counts and sums add, extremes take least and greatest, sketches merge, key counts add by key,
and squared deviations add with the parts' distances from the common mean (no difference of large sums).
All are aggregations with partial results before the shuffle; only key counts grow with the data.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualia.functions.blocks import codegen_field_limit, pack
from qualia.functions.predicates import field_type, is_numeric, qcol, ratio, resolve_name, str_lit
from qualia.operators.frequencies import frequencies, key_set_table
from qualia.operators.metrics import (
    METRIC_SCHEMA,
    Analyzer,
    ApproxCountDistinct,
    Completeness,
    Compliance,
    Histogram,
    Maximum,
    MaxLength,
    Mean,
    MetricError,
    Minimum,
    MinLength,
    Size,
    StandardDeviation,
    Sum,
    _ColumnAnalyzer,
    _cond,
    _histogram_rows,
    _meta,
    _meta_sql,
    _named,
)

STATE_COLUMNS = {
    "part": "string", "state": "string", "key": "string", "nn": "boolean", "n": "bigint", "total": "double", "spread": "double",
    "low": "double", "high": "double", "sketch": "binary",
}
STATE_SCHEMA = ", ".join(f"{name} {kind}" for name, kind in STATE_COLUMNS.items())
_HLL_BITS = 14  # standard error of about 0.8 %
_KLL_SIZE = 400  # rank error of about 0.7 %
_ROWS_A_TASK = 1_000_000  # key counts one task adds up: some hundred bytes each in memory, a few in files


@dataclass(frozen=True, init=False)
class ApproxQuantile(_ColumnAnalyzer):
    """A quantile of a numeric column from a KLL sketch (rank error of about 0.7 %)."""

    quantile: float = 0.5

    imperative = True
    cost = 60

    def __init__(self, column: str, quantile: float, where: str | None = None):
        super().__init__(column, where)
        object.__setattr__(self, "quantile", quantile)

    def metric_name(self) -> str:
        return _named(f"ApproxQuantile-{self.quantile}", self.where)

    def scan_value(self, df: DataFrame) -> Column:
        values = F.when(_cond(self.where), qcol(resolve_name(df, self.column)).cast("double"))
        return F.call_function("kll_sketch_get_quantile_double", F.call_function("kll_sketch_agg_double", values, F.lit(_KLL_SIZE)),
                               F.lit(float(self.quantile)))


def _state(kind: str, columns: Sequence[str], where: str | None) -> str:
    return json.dumps([kind, *columns, where])


def _finite_zero(c: Column) -> Column:
    v = c.cast("double")
    return F.when(v == 0, F.lit(0.0)).otherwise(v)


@dataclass(frozen=True)
class _Spec:
    """A scan state: its aggregate columns by state column."""

    name: str
    columns: dict
    cost: int
    sketch: bool = False


def _scan_specs(df: DataFrame, a: Analyzer) -> list[_Spec]:
    """The scan states of one analyzer."""
    w = _cond(a.where)
    rows = _Spec(_state("rows", [], a.where), {"n": F.count_if(w)}, 2)
    if isinstance(a, Size):
        return [rows]
    if isinstance(a, Compliance):
        return [rows, _Spec(_state("true", [a.predicate], a.where), {"n": F.count_if(w & F.expr(a.predicate))}, 2)]
    column = resolve_name(df, a.column)
    c, kind = qcol(column), field_type(df, column)
    if isinstance(a, Completeness):
        return [rows, _Spec(_state("present", [column], a.where), {"n": F.count_if(w & c.isNotNull())}, 2)]
    if isinstance(a, (MaxLength, MinLength)):
        if not isinstance(kind, T.StringType):
            raise TypeError(f"{a.name} needs a string column, {column} is {kind.simpleString()}")
        size = F.when(w, F.length(c)).cast("double")
        return [_Spec(_state("lengths", [column], a.where), {"low": F.min(size), "high": F.max(size)}, 4)]
    if isinstance(a, ApproxCountDistinct):
        text = F.when(w, c.cast("string"))
        return [_Spec(_state("distinct", [column], a.where), {"sketch": F.hll_sketch_agg(text, _HLL_BITS)}, 60, True)]
    if not is_numeric(kind):
        raise TypeError(f"{a.metric_name()} needs a numeric column, {column} is {kind.simpleString()}")
    v = F.when(w, _finite_zero(c))
    if isinstance(a, ApproxQuantile):
        sketch = F.call_function("kll_sketch_agg_double", v, F.lit(_KLL_SIZE))
        return [_Spec(_state("ranks", [column], a.where), {"sketch": sketch}, 60, True)]
    return [_Spec(_state("moments", [column], a.where), {
        "n": F.count(v), "total": F.sum(v), "spread": F.var_pop(v) * F.count(v), "low": F.min(v), "high": F.max(v)}, 15)]


def _key_state(df: DataFrame, a: Analyzer) -> tuple[str, tuple, str | None]:
    columns, where = a.key(df)
    return _state("values", columns, where), columns, where


def metric_states(df: DataFrame, analyzers: Sequence[Analyzer], part: str) -> DataFrame:
    """States of ``df``, named ``part``, for all ``analyzers``: shared scans for scan metrics, one frequency
    aggregation for all grouping metrics."""
    specs: dict[str, _Spec] = {}
    keys: dict[str, tuple] = {}
    for a in dict.fromkeys(analyzers):
        try:
            if a.grouping:
                name, columns, where = _key_state(df, a)
                keys[name] = (columns, where)
            else:
                specs.update({s.name: s for s in _scan_specs(df, a)})
        except (KeyError, TypeError) as e:
            raise MetricError(a, str(e.args[0] if e.args else e)) from e
    if not specs and not keys:
        raise ValueError("no metrics")
    out: DataFrame | None = None
    limit = codegen_field_limit(df.sparkSession)
    names = list(specs)
    blocks = pack([n for n in names if not specs[n].sketch], lambda n: specs[n].cost, limit) + pack(
        [n for n in names if specs[n].sketch], lambda n: specs[n].cost, limit)
    for block in blocks:
        wide = df.agg(*[value.alias(f"s{i}_{field}") for i, n in enumerate(block) for field, value in specs[n].columns.items()])
        rows = []
        for i, name in enumerate(block):
            fields = [f"'part', {str_lit(part)}", f"'state', {str_lit(name)}"]
            for field, kind in list(STATE_COLUMNS.items())[2:]:
                fields.append(f"'{field}', CAST({f's{i}_{field}' if field in specs[name].columns else 'NULL'} AS {kind})")
            rows.append(f"named_struct({', '.join(fields)})")
        made = wide.selectExpr(f"inline(array({', '.join(rows)}))")
        out = made if out is None else out.unionByName(made)
    if keys:
        names = list(keys)
        counted = frequencies(df, [keys[n][0] for n in names], [keys[n][1] for n in names])
        label = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("k") + 1)
        made = counted.select(
            F.lit(part).alias("part"), label.alias("state"), F.col("v").alias("key"), "nn", "n",
            *[F.lit(None).cast(kind).alias(c) for c, kind in list(STATE_COLUMNS.items())[5:]])
        out = made if out is None else out.unionByName(made)
    return out


def _union(states: Iterable[DataFrame]) -> DataFrame:
    out = None
    for s in states:
        s = s.select(*[F.col(c).cast(kind).alias(c) for c, kind in STATE_COLUMNS.items()])
        out = s if out is None else out.unionByName(s)
    if out is None:
        raise ValueError("no states")
    return out


def _kind(state: Column) -> Column:
    return F.get_json_object(state, "$[0]")


def merge_states(*states: DataFrame, part: str = "all", tasks: int | None = None) -> DataFrame:
    """The states of all rows that ``states`` (any number of tables, of any number of parts) are about, as part ``part``.
    Key counts are dealt out by key before they are added (to ``tasks`` tasks; None: as many as the session shuffles to):
    a part has each key once, so adding up before that only fills a reading task's memory."""
    rows = _union(states).withColumn("kind", _kind(F.col("state")))
    key = ["state", "key", "nn"]
    keyed = rows.where("kind = 'values'").select(*key, "n")
    keyed = (keyed.repartition(tasks, *key) if tasks else keyed.repartition(*key)).groupBy(*key).agg(F.sum("n").alias("n"))
    # few rows: scan states x parts
    moment = F.when(F.col("total").isNotNull(), F.struct(F.col("n").cast("double").alias("n"), "total", "spread"))
    fixed = rows.where("kind <> 'values'").groupBy("kind", "state").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.collect_list(moment).alias("moments"), F.min("low").alias("low"),
        F.max("high").alias("high"), F.hll_union_agg(F.when(F.col("kind") == "distinct", F.col("sketch"))).alias("hll"),
        F.call_function("kll_merge_agg_double", F.when(F.col("kind") == "ranks", F.col("sketch"))).alias("kll"))
    sketch = F.when(F.col("kind") == "distinct", F.col("hll")).when(F.col("kind") == "ranks", F.col("kll"))
    fixed = fixed.select("state", "n", "total", _pooled("moments").alias("spread"), "low", "high", sketch.alias("sketch"))
    out = fixed.unionByName(keyed, allowMissingColumns=True)
    return out.withColumn("part", F.lit(part)).select(*[F.col(c).cast(kind).alias(c) for c, kind in STATE_COLUMNS.items()])


def _key_tasks(rows: Iterable[int]) -> int:
    """Number of tasks that add up so many stored rows."""
    return sum(rows) // _ROWS_A_TASK + 1


def _pooled(moments: str) -> Column:
    """Squared deviations of all rows from those of the parts: each step adds the distance of the two means."""

    def step(a: Column, b: Column) -> Column:
        n = a["n"] + b["n"]
        off = b["total"] / b["n"] - F.when(a["n"] > 0, a["total"] / a["n"]).otherwise(0.0)
        apart = F.when(a["n"] > 0, off * off * a["n"] * b["n"] / n).otherwise(0.0)
        return F.struct(n.alias("n"), (a["total"] + b["total"]).alias("total"), (a["spread"] + b["spread"] + apart).alias("spread"))

    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "total", "spread")])
    ordered = F.array_sort(moments)  # the result does not depend on the order of the parts
    return F.when(F.size(moments) > 0, F.aggregate(ordered, zero, step, lambda x: x["spread"]))


def _value(df: DataFrame, a: Analyzer) -> tuple[list[tuple[str, Column]], Callable[..., Column]]:
    """The (state, column) values a scan metric reads, and the metric from them."""
    names = [s.name for s in _scan_specs(df, a)]
    col = F.col
    if isinstance(a, Size):
        return [(names[0], col("n"))], lambda n: F.coalesce(n, F.lit(0))
    if isinstance(a, (Completeness, Compliance)):
        return [(names[0], col("n")), (names[1], col("n"))], lambda n, part: ratio(part, n)
    if isinstance(a, (MaxLength, Maximum)):
        return [(names[0], col("high"))], lambda v: v
    if isinstance(a, (MinLength, Minimum)):
        return [(names[0], col("low"))], lambda v: v
    if isinstance(a, Sum):
        return [(names[0], col("total"))], lambda v: v
    if isinstance(a, Mean):
        return [(names[0], col("n")), (names[0], col("total"))], lambda n, total: F.when(n > 0, total / n)
    if isinstance(a, StandardDeviation):
        return [(names[0], col("n")), (names[0], col("spread"))], lambda n, spread: F.when(n > 0, F.sqrt(spread / n))
    if isinstance(a, ApproxCountDistinct):
        return [(names[0], F.hll_sketch_estimate("sketch"))], lambda v: F.coalesce(v, F.lit(0))
    if isinstance(a, ApproxQuantile):
        q = F.when(F.call_function("kll_sketch_get_n_double", "sketch") > 0,
                   F.call_function("kll_sketch_get_quantile_double", "sketch", F.lit(float(a.quantile))))
        return [(names[0], q)], lambda v: v
    raise TypeError(f"{a.metric_name()} has no mergeable state")


def metrics_from_states(states: DataFrame, analyzers: Sequence[Analyzer], schema: T.StructType) -> DataFrame:
    """``entity, instance, name, value`` of ``analyzers`` over all rows the states are about. ``schema`` is that of
    the table (column names and types; no rows are read). A state that was not stored is an error."""
    spark = states.sparkSession
    empty = spark.createDataFrame([], schema)
    known = {r.state: r.n for r in states.groupBy("state").agg(F.count(F.lit(1)).alias("n")).collect()}  # names of states, not data
    merged = merge_states(states, tasks=_key_tasks(known.values()))
    distinct = list(dict.fromkeys(analyzers))
    scan = [a for a in distinct if not a.grouping]
    grouped = [a for a in distinct if a.grouping]
    wanted = {s.name for a in scan for s in _scan_specs(empty, a)} | {_key_state(empty, a)[0] for a in grouped}
    missing = sorted(n for n in wanted - known.keys() if json.loads(n)[0] != "values")  # a part without rows has no key counts
    if missing:
        raise ValueError(f"no such states: {missing}")
    parts = []
    if scan:
        plans = [_value(empty, a) for a in scan]
        read = [(i, j, state, c) for i, (needs, _) in enumerate(plans) for j, (state, c) in enumerate(needs)]
        one = merged.where(_kind(F.col("state")) != "values").agg(
            *[F.max(F.when(F.col("state") == state, c)).alias(f"v{i}_{j}") for i, j, state, c in read])
        values = one.select(*[make(*[F.col(f"v{i}_{j}") for j in range(len(needs))]).cast("double").alias(f"m{i}")
                              for i, (needs, make) in enumerate(plans)])
        parts.append(values.selectExpr(f"inline(array({', '.join(_meta_sql(a, f'm{i}', i) for i, a in enumerate(scan))}))"))
    if grouped:
        keys = list(dict.fromkeys(_key_state(empty, a)[0] for a in grouped))
        number = F.array_position(F.array(*[F.lit(k) for k in keys]), F.col("state")).cast("int") - 1
        freq = merged.where(F.col("state").isin(keys)).select(number.alias("k"), F.col("key").alias("v"), "nn", "n")
        placed = [(i, a, keys.index(_key_state(empty, a)[0])) for i, a in enumerate(grouped, len(scan))]
        plain = [(i, a, k) for i, a, k in placed if not isinstance(a, Histogram)]
        if plain:
            structs = [F.when(F.col("k") == k, _meta(a, a.from_stats(F.col), key=i)) for i, a, k in plain]
            parts.append(key_set_table(freq, len(keys)).select(F.inline(F.filter(F.array(*structs), lambda x: x.isNotNull()))))
        hist = [(i, a, k) for i, a, k in placed if isinstance(a, Histogram)]
        if hist:
            parts += _histogram_rows(freq, hist)
    if not parts:
        return spark.createDataFrame([], METRIC_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("metric_key")


def save_states(states: DataFrame, path: str) -> None:
    """Store states under ``path``, partitioned by part. A part that is there is replaced as a whole, so a
    repeated batch counts once. A part's key counts are dealt out by key: they grow with the data."""
    states.repartition("part", "state", "key").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def stored_states(spark: SparkSession, path: str, parts: Sequence[str] | None = None) -> DataFrame:
    """The stored states (only those of ``parts``: other folders are not read)."""
    columns = [f"{c} {kind}" for c, kind in STATE_COLUMNS.items() if c != "part"]
    out = spark.read.schema(", ".join([*columns, "part string"])).parquet(path)
    return out if parts is None else out.where(F.col("part").isin(list(parts)))


def compact_states(spark: SparkSession, path: str, target: str, part: str, parts: Sequence[str] | None = None) -> None:
    """Merge stored parts into one part of another state table (the source stays as it is)."""
    stored = stored_states(spark, path, parts)
    save_states(merge_states(stored, part=part, tasks=_key_tasks([stored.count()])), target)
