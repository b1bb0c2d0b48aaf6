"""Column profiles.

``profile(df)`` (Q1) gives one row per column in TWO aggregation passes whatever the number
of columns: (1) a global aggregation with null / NaN, whitespace-only, empty-string counts,
non-null count, mean, sample standard deviation, min and max of every column (packed into
blocks that fit the session's codegen field limit, read together in one job); (2) one
frequency table for all columns (null is a value) giving the number of distinct values,
the most and least frequent value, and string min/max. The reference's per-column jobs
(7C + 4 actions) become one job.

``column_profiles(df)`` (P1-P6) is the library-style profile: completeness, approximate
distinct count, inferred data type with type counts, histogram of low-cardinality
columns, numeric statistics (population standard deviation) and optional approximate
percentiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualia.functions.predicates import (
    COMPLEX_TYPES,
    FLOATING_TYPES,
    SPACES_REGEX,
    is_numeric,
    qcol,
    quote_ident,
    ratio,
    resolve_name,
    sql_literal,
    str_lit,
)
from qualia.operators.extremes import frequency_extremes
from qualia.operators.frequencies import frequencies
from qualia.functions.blocks import codegen_field_limit, pack

PROFILE_COLUMNS = [
    "schema_name",
    "table_name",
    "column_names",
    "data_types",
    "num_rows",
    "num_null",
    "num_spaces",
    "num_blank",
    "count",
    "mean",
    "stddev",
    "min",
    "max",
    "num_distinct",
    "most_freq_value",
    "most_freq_value_count",
    "least_freq_value",
    "least_freq_value_count",
]

# Type labels of the library profile and the patterns that infer them
# from text (null values count as Unknown, anything else as String).
TYPE_LABELS = ("Boolean", "Fractional", "Integral", "Unknown", "String")
INTEGRAL_REGEX = r"^[+-]?\d+$"
FRACTIONAL_REGEX = r"^[+-]?\d*\.\d+$"
BOOLEAN_REGEX = r"^(true|false)$"

DEFAULT_HISTOGRAM_THRESHOLD = 120
DEFAULT_PERCENTILES = tuple(round(i / 100, 2) for i in range(1, 100))


def _canonical_zero(q: str, dt: T.DataType) -> str:
    """SQL for a column whose floating -0.0 reads as 0.0 (equal values; min/max may return
    either, so the text of the result is made deterministic)."""
    if isinstance(dt, FLOATING_TYPES):
        return f"CASE WHEN {q} = 0 THEN CAST(0 AS {dt.simpleString().upper()}) ELSE {q} END"
    return q


def _var_width(dt: T.DataType) -> bool:
    """Types whose min/max buffers are not fixed-width (sort-based aggregation)."""
    return isinstance(dt, (T.StringType, T.BinaryType)) or (isinstance(dt, T.DecimalType) and dt.precision > 18)


def _columns(df: DataFrame, cols: Sequence[str] | None) -> list[tuple[str, T.DataType]]:
    names = [resolve_name(df, c) for c in cols] if cols else list(df.columns)
    out = []
    for n in names:
        dt = df.schema[n].dataType
        if isinstance(dt, COMPLEX_TYPES):
            raise TypeError(f"column {n!r} is {dt.simpleString()}; profiles take atomic columns only")
        out.append((n, dt))
    if not out:
        raise ValueError("no columns to profile")
    return out


def profile(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    schema_name: str = "schema_name",
    table_name: str = "table_name",
    frequencies_mode: str = "exact",
) -> DataFrame:
    """One row per profiled column (see ``PROFILE_COLUMNS``).

    ``frequencies_mode``: ``exact`` (every column), ``extremes`` (the same most and least frequent values,
    found by ``frequency_extremes`` without counting every value; null ``num_distinct``) or ``none`` (null
    ``num_distinct`` and most/least frequent values).
    """
    columns = _columns(df, cols)
    data = df.select(*[qcol(c) for c, _ in columns])
    # Columns that get a frequency table (step 2).
    if frequencies_mode in ("none", "extremes"):
        chosen = []
    elif frequencies_mode == "exact":
        chosen = list(range(len(columns)))
    else:
        raise ValueError("frequencies_mode must be exact, extremes or none")
    # String min/max come from the frequency table when the column has one (its values are
    # the strings themselves): step 1 then holds only fixed-width aggregation buffers and
    # stays a code-generated hash aggregation instead of a sort-based one.
    text_from_freq = {i for i in chosen if isinstance(columns[i][1], T.StringType)}
    # (1) global aggregation of the per-column statistics, written as SQL expressions.
    # Packed into blocks that fit `spark.sql.codegen.maxFields`, so each block stays a
    # whole-stage code-generated aggregation (one wide aggregation over that limit runs
    # interpreted, several times slower); on columnar sources a block reads only its own
    # columns, so blocks do not multiply I/O. String min/max (sort-based aggregation) get
    # blocks of their own.
    def agg_and_struct(i: int, c: str, dt: T.DataType) -> tuple[list[str], str]:
        q = quote_ident(c)
        num = is_numeric(dt)
        null = f"{q} IS NULL OR isnan({q})" if isinstance(dt, FLOATING_TYPES) else f"{q} IS NULL"
        text = isinstance(dt, T.StringType)
        m = _canonical_zero(q, dt)
        minmax = (
            [f"CAST(NULL AS STRING) AS min{i}", f"CAST(NULL AS STRING) AS max{i}"]
            if i in text_from_freq
            else [f"CAST(min({m}) AS STRING) AS min{i}", f"CAST(max({m}) AS STRING) AS max{i}"]
        )
        aggs = [
            f"count_if({null}) AS null{i}",
            (f"count_if({q} RLIKE {sql_literal(SPACES_REGEX)})" if text else "0L") + f" AS spaces{i}",
            (f"count_if({q} = '')" if text else "0L") + f" AS blank{i}",
            f"count({q}) AS count{i}",
            (f"avg(CAST({q} AS DOUBLE))" if num else "CAST(NULL AS DOUBLE)") + f" AS mean{i}",
            (f"stddev_samp(CAST({q} AS DOUBLE))" if num else "CAST(NULL AS DOUBLE)") + f" AS std{i}",
            *minmax,
        ]
        struct = (
            f"named_struct('k', {i}, 'column_names', {str_lit(c)}, 'data_types', {str_lit(dt.simpleString())}, "
            f"'num_rows', num_rows, 'num_null', null{i}, 'num_spaces', spaces{i}, 'num_blank', blank{i}, "
            f"'count', count{i}, 'mean', mean{i}, 'stddev', std{i}, 'min', min{i}, 'max', max{i})"
        )
        return aggs, struct

    def fields_of(i: int, dt: T.DataType) -> int:
        # 8 output columns + aggregation buffer slots (counts 1, avg 2, stddev 3, min/max 1)
        return 8 + 4 + (5 if is_numeric(dt) else 0) + (0 if i in text_from_freq else 2)

    sort_based = [i for i, (_, dt) in enumerate(columns) if _var_width(dt) and i not in text_from_freq]
    hash_based = [i for i in range(len(columns)) if i not in sort_based]
    limit = codegen_field_limit(df.sparkSession)
    blocks = pack(hash_based, lambda i: fields_of(i, columns[i][1]), limit) + pack(
        sort_based, lambda i: fields_of(i, columns[i][1]), limit
    )
    per_col = None
    for block in blocks:
        parts = [agg_and_struct(i, *columns[i]) for i in block]
        aggs = ["count(1) AS num_rows"] + [a for p_aggs, _ in parts for a in p_aggs]
        one = data.selectExpr(*aggs).selectExpr(f"inline(array({', '.join(st for _, st in parts)}))")
        per_col = one if per_col is None else per_col.unionByName(one)
    # (2) one frequency table for the chosen columns
    if chosen:
        freq = frequencies(data, [columns[i][0] for i in chosen])
        remap = F.element_at(F.array(*[F.lit(i) for i in chosen]), F.col("k") + 1)
        value = F.when(F.col("nn"), F.col("v"))
        top = freq.groupBy("k").agg(
            F.count(F.lit(1)).alias("num_distinct"),
            F.min(F.struct((-F.col("n")).alias("neg"), F.col("v"))).alias("most"),
            F.min(F.struct(F.col("n"), F.col("v"))).alias("least"),
            F.min(value).alias("vmin"),
            F.max(value).alias("vmax"),
        ).select(
            remap.alias("k"),
            "num_distinct",
            "vmin",
            "vmax",
            F.col("most.v").alias("most_freq_value"),
            (-F.col("most.neg")).alias("most_freq_value_count"),
            F.col("least.v").alias("least_freq_value"),
            F.col("least.n").alias("least_freq_value_count"),
        )
        # One row per column on each side (bounded by the schema): broadcast the frequency summary.
        joined = per_col.join(F.broadcast(top), "k", "left")
        zero = F.when(F.col("num_rows") == 0, F.lit(0).cast("long"))
        text_k = [F.lit(i) for i in sorted(text_from_freq)]
        from_freq = F.col("k").isin(*text_k) if text_k else F.lit(False)
        joined = joined.withColumns(
            {
                "min": F.when(from_freq, F.col("vmin")).otherwise(F.col("min")),
                "max": F.when(from_freq, F.col("vmax")).otherwise(F.col("max")),
                "num_distinct": F.coalesce("num_distinct", zero),
                "most_freq_value_count": F.coalesce("most_freq_value_count", zero),
                "least_freq_value_count": F.coalesce("least_freq_value_count", zero),
            }
        )
    elif frequencies_mode == "extremes":
        found = frequency_extremes(data).withColumnRenamed("column_name", "column_names")  # one row per column
        joined = per_col.join(F.broadcast(found), "column_names").withColumn("num_distinct", F.lit(None).cast("long"))
    else:
        joined = per_col.select(
            "*",
            F.lit(None).cast("long").alias("num_distinct"),
            F.lit(None).cast("string").alias("most_freq_value"),
            F.lit(None).cast("long").alias("most_freq_value_count"),
            F.lit(None).cast("string").alias("least_freq_value"),
            F.lit(None).cast("long").alias("least_freq_value_count"),
        )
    return joined.select(
        F.lit(schema_name).alias("schema_name"),
        F.lit(table_name).alias("table_name"),
        *PROFILE_COLUMNS[2:],
    )


# ------------------------------------------------------------------ library-style profile


def _type_of(dt: T.DataType) -> str:
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "Integral"
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "Fractional"
    if isinstance(dt, T.BooleanType):
        return "Boolean"
    if isinstance(dt, T.StringType):
        return "String"
    return "Unknown"


def column_profiles(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    histogram_threshold: int = DEFAULT_HISTOGRAM_THRESHOLD,
    percentiles: Sequence[float] | None = None,
    percentile_accuracy: int = 10000,
    rsd: float = 0.05,
) -> DataFrame:
    """Library-style profile, one row per column; a lazy DataFrame.

    Columns: ``column_name, num_rows, completeness, approx_distinct, bins, data_type,
    is_data_type_inferred, type_counts map<string,long>, histogram
    array<struct<value,count,ratio>>, histogram_kept, mean, maximum, minimum, sum, std_dev,
    approx_percentiles array<double>``. ``bins`` is the exact number of distinct values (null
    is a value); a histogram is gathered into its row for columns with at most
    ``histogram_threshold`` bins, and ``histogram_kept`` says so (``histogram_long`` gives
    the bins of any column). Parts meet by column number, one row per column on each side.
    """
    columns = _columns(df, cols)
    data = df.select(*[qcol(c) for c, _ in columns])
    pct_list = ", ".join(f"{float(p)!r}D" for p in (percentiles or []))
    limit = codegen_field_limit(df.sparkSession)
    null_double, zero = "CAST(NULL AS DOUBLE)", "0L"

    def stats_of(i: int) -> tuple[list[str], str]:
        c, dt = columns[i]
        q = quote_ident(c)
        aggs = [f"count({q}) AS nn{i}"]
        text = isinstance(dt, T.StringType)
        if text:
            aggs += [f"count_if({q} RLIKE {sql_literal(rx)}) AS {name}{i}"
                     for name, rx in (("tb", BOOLEAN_REGEX), ("tf", FRACTIONAL_REGEX), ("ti", INTEGRAL_REGEX))]
        numbers = [null_double] * 5
        if is_numeric(dt):
            d = f"CAST({_canonical_zero(q, dt)} AS DOUBLE)"
            if isinstance(dt, FLOATING_TYPES):
                d = f"CASE WHEN NOT isnan({q}) THEN {d} END"
            aggs += [f"avg({d}) AS mean{i}", f"max({d}) AS max{i}", f"min({d}) AS min{i}", f"sum({d}) AS sum{i}",
                     f"stddev_pop({d}) AS std{i}"]
            numbers = [f"{name}{i}" for name in ("mean", "max", "min", "sum", "std")]
        tb, tf, ti = (f"tb{i}", f"tf{i}", f"ti{i}") if text else (zero, zero, zero)
        values = [
            ("k", str(i)), ("column_name", str_lit(c)), ("num_rows", "num_rows"), ("nn", f"nn{i}"), ("tb", tb), ("tf", tf), ("ti", ti),
            ("text", "TRUE" if text else "FALSE"), ("declared", str_lit(_type_of(dt))),
            *zip(("mean", "maximum", "minimum", "sum", "std_dev"), numbers),
        ]
        return aggs, "named_struct(" + ", ".join(f"'{name}', {v}" for name, v in values) + ")"

    def sketch_of(i: int) -> tuple[list[str], str]:
        c, dt = columns[i]
        q = quote_ident(c)
        aggs, pct = [f"approx_count_distinct({q}, {float(rsd)!r}D) AS acd{i}"], "CAST(NULL AS ARRAY<DOUBLE>)"
        if percentiles and is_numeric(dt):
            d = f"CAST({q} AS DOUBLE)"
            if isinstance(dt, FLOATING_TYPES):
                d = f"CASE WHEN NOT isnan({q}) THEN {d} END"
            aggs.append(f"CAST(percentile_approx({d}, array({pct_list}), {int(percentile_accuracy)}) AS ARRAY<DOUBLE>) AS pct{i}")
            pct = f"pct{i}"
        return aggs, f"named_struct('sk', {i}, 'approx_distinct', acd{i}, 'approx_percentiles', {pct})"

    def rows_of(blocks: list[list[int]], make) -> DataFrame:
        out = None
        for block in blocks:
            parts = [make(i) for i in block]
            one = data.selectExpr("count(1) AS num_rows", *[a for aggs, _ in parts for a in aggs])
            one = one.selectExpr(f"inline(array({', '.join(st for _, st in parts)}))")
            out = one if out is None else out.unionByName(one)
        return out

    # Statistics in blocks that fit the codegen field limit; sketch aggregates (imperative,
    # never code-generated) in blocks of their own so they do not slow the rest.
    every = list(range(len(columns)))
    stats = rows_of(pack(every, lambda i: 10 + 8 * is_numeric(columns[i][1]), limit), stats_of)
    sketches = rows_of(pack(every, lambda i: 2, limit), sketch_of)
    freq = frequencies(data, [c for c, _ in columns])
    bins = freq.groupBy("k").agg(F.count(F.lit(1)).alias("bins")).select(F.col("k").alias("bk"), "bins")
    lists = _bounded_histograms(freq, histogram_threshold)
    # at most one row per column on each broadcast side
    out = stats.join(F.broadcast(sketches), F.col("k") == F.col("sk")).join(F.broadcast(bins), F.col("k") == F.col("bk"), "left")
    out = out.join(F.broadcast(lists), F.col("k") == F.col("hk"), "left")
    string = "(nn - tb - tf - ti)"
    data_type = (
        f"CASE WHEN NOT text THEN declared WHEN nn = 0 THEN 'Unknown' WHEN {string} > 0 OR (tb > 0 AND ti + tf > 0) THEN 'String' "
        "WHEN tb > 0 THEN 'Boolean' WHEN tf > 0 THEN 'Fractional' ELSE 'Integral' END"
    )
    counts = f"map('Boolean', tb, 'Fractional', tf, 'Integral', ti, 'Unknown', num_rows - nn, 'String', {string})"
    return out.selectExpr(
        "column_name", "num_rows", "CASE WHEN num_rows > 0 THEN CAST(nn AS DOUBLE) / num_rows END AS completeness", "approx_distinct",
        "coalesce(bins, 0L) AS bins", f"{data_type} AS data_type",
        f"text AND ({data_type}) NOT IN ('String', 'Unknown') AS is_data_type_inferred",
        f"CASE WHEN text THEN {counts} ELSE map_filter({counts}, (t, n) -> FALSE) END AS type_counts",
        "histogram", "histogram IS NOT NULL AS histogram_kept", "mean", "maximum", "minimum", "sum", "std_dev", "approx_percentiles",
    )


def _bounded_histograms(freq: DataFrame, threshold: int) -> DataFrame:
    """hk, histogram of the key sets with at most ``threshold`` bins (so a gathered list is bounded),
    by count descending, then value."""
    per = freq.groupBy("k").agg(F.count(F.lit(1)).alias("bins"), F.sum("n").alias("rows")).where(F.col("bins") <= threshold)
    per = per.select(F.col("k").alias("hk"), "rows")
    # null-safe key, as in histogram_long; one row per column is broadcast
    long = freq.join(F.broadcast(per), freq["k"].eqNullSafe(per["hk"]))
    item = F.struct((-F.col("n")).alias("o"), F.coalesce(F.col("v"), F.lit("NullValue")).alias("value"), F.col("n").alias("count"),
                    ratio(F.col("n"), F.col("rows")).alias("ratio"))
    lists = long.groupBy("hk").agg(F.array_sort(F.collect_list(item)).alias("h"))
    return lists.select("hk", F.transform("h", lambda x: F.struct(
        x["value"].alias("value"), x["count"].alias("count"), x["ratio"].alias("ratio"))).alias("histogram"))


def histogram_long(df: DataFrame, cols: Sequence[str], threshold: int | None = None) -> DataFrame:
    """``(column_name, value, count, ratio)``: every bin of every column.

    Null is the bin ``NullValue``; ratio is over all rows. With a ``threshold`` only columns
    with at most that many bins are returned (``column_profiles`` has the number of bins of
    each). The per-column bin counts (one row per column) are broadcast back to the
    frequency table; no group is ever gathered whole.
    """
    names = [resolve_name(df, c) for c in cols]
    freq = frequencies(df, names)
    per = freq.groupBy("k").agg(F.count(F.lit(1)).alias("bins"), F.sum("n").alias("rows"))
    if threshold is not None:
        per = per.filter(F.col("bins") <= threshold)
    label = F.array(*[F.lit(n) for n in names])
    # null-safe key (k is never null): an ordinary equi-join would infer `k IS NOT NULL`
    # below the frequency aggregation and keep Spark from reusing its shuffle
    per = per.withColumnRenamed("k", "pk")
    return freq.join(F.broadcast(per), freq["k"].eqNullSafe(per["pk"])).select(
        F.element_at(label, F.col("k") + 1).alias("column_name"),
        F.coalesce(F.col("v"), F.lit("NullValue")).alias("value"),
        F.col("n").alias("count"),
        ratio(F.col("n"), F.col("rows")).alias("ratio"),
    )
