"""Registered queries for column profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualia.operators.extremes import frequency_extremes
from qualia.operators.metrics import CountDistinct, run_metrics
from qualia.operators.profile import column_profiles, histogram_long, profile
from qualia.plans.common import table
from qualia.plans.metric_queries import documents_labels


def orders_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose priority holds nulls, empty strings and whitespace-only strings."""
    return table(spark, sf_dir, "orders").withColumn(
        "o_orderpriority",
        F.expr(
            "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL WHEN o_orderpriority = '5-LOW' THEN '' "
            "WHEN o_orderpriority = '3-MEDIUM' THEN '   ' ELSE o_orderpriority END"
        ),
    )


def q_profile_basic(spark, sf_dir):
    out = profile(orders_dirty(spark, sf_dir), table_name="orders")
    return out.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


def q_profile_frequencies(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    out = profile(df, ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey", "l_shipdate"])
    return out.select(
        "column_names", "num_distinct", "most_freq_value", "most_freq_value_count", "least_freq_value",
        "least_freq_value_count",
    )


def q_profile_numeric(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    lib = column_profiles(df, cols)
    return lib.select(
        "column_name",
        "completeness",
        F.round("mean", 4).alias("mean"),
        F.round("maximum", 4).alias("maximum"),
        F.round("minimum", 4).alias("minimum"),
        F.round("sum", 2).alias("sum"),
        F.round("std_dev", 4).alias("std_dev"),
    )


def q_profile_sample_stats(spark, sf_dir):
    """A4: non-null count, mean and sample standard deviation per numeric column."""
    df = table(spark, sf_dir, "lineitem")
    out = profile(df, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], frequencies_mode="none")
    return out.select("column_names", "count", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"))


def q_profile_min_max(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    out = profile(df, ["ts", "event_type", "user_id", "value", "props"], frequencies_mode="none")
    return out.select("column_names", "data_types", "min", "max")


def events_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns whose values look like integers, decimals, booleans or words."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.regexp_extract("props", r"(\d+)", 1).alias("props_digits"),
        F.col("event_type"),
        F.col("value").cast("string").alias("value_text"),
        F.when(F.col("value") > 50, F.lit("true")).when(F.col("value") > 10, F.lit("false")).alias("is_big"),
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("user_id").cast("string")).alias(
            "user_text"
        ),
        F.col("user_id"),
    )


def q_profile_types(spark, sf_dir):
    out = column_profiles(events_text(spark, sf_dir))
    tc = F.col("type_counts")
    return out.select(
        "column_name",
        "data_type",
        "is_data_type_inferred",
        F.coalesce(tc["Boolean"], F.lit(0)).alias("n_boolean"),
        F.coalesce(tc["Fractional"], F.lit(0)).alias("n_fractional"),
        F.coalesce(tc["Integral"], F.lit(0)).alias("n_integral"),
        F.coalesce(tc["Unknown"], F.lit(0)).alias("n_unknown"),
        F.coalesce(tc["String"], F.lit(0)).alias("n_string"),
    )


def q_profile_approx_distinct(spark, sf_dir):
    """P2 bound test: approximate distinct count within 10% of the exact count."""
    df = table(spark, sf_dir, "lineitem")
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"]
    approx = column_profiles(df, cols).select("column_name", "approx_distinct")
    exact = run_metrics(df, [CountDistinct(c) for c in cols]).select(
        F.col("instance").alias("column_name"), F.col("value").cast("long").alias("distinct_count")
    )
    return exact.join(approx, "column_name").select(
        "column_name",
        "distinct_count",
        (F.abs(F.col("approx_distinct") - F.col("distinct_count")) <= 0.1 * F.col("distinct_count")).alias(
            "within_bound"
        ),
    )


PERCENTILES = (0.1, 0.25, 0.5, 0.75, 0.9)
PERCENTILE_ACCURACY = 1_000_000  # a rank error below one row up to half as many rows: the values are exact there


def q_profile_percentiles(spark, sf_dir):
    """Percentiles of two columns, one row each."""
    df = table(spark, sf_dir, "part").select("p_retailprice", "p_size")
    prof = column_profiles(df, percentiles=PERCENTILES, percentile_accuracy=PERCENTILE_ACCURACY)
    levels = F.array(*[F.lit(p) for p in PERCENTILES])
    return prof.select("column_name", F.inline(F.arrays_zip(levels.alias("percentile"), F.col("approx_percentiles").alias("value"))))


def q_profile_histogram(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("event_type", F.expr("nullif(event_type, 'error')"))
    conv = table(spark, sf_dir, "conversations")
    return histogram_long(events, ["event_type"]).unionByName(histogram_long(conv, ["role"]))


def q_profile_histogram_wide(spark, sf_dir):
    """Every bin of a column with many values, and the exact number of bins in its profile."""
    events = table(spark, sf_dir, "events")
    bins = column_profiles(events, ["user_id"]).select("column_name", "bins", "histogram_kept")
    return histogram_long(events, ["user_id"]).join(bins, "column_name")


def docs_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = documents_labels(spark, sf_dir)
    return df.select(
        F.expr("CASE WHEN lang = 'es' THEN '' WHEN lang = 'de' THEN '   ' ELSE lang END").alias("lang"),
        F.col("quality"),
        F.expr("CASE WHEN n_chars > 5000 THEN double('NaN') ELSE CAST(n_chars AS DOUBLE) END").alias("n_chars"),
        F.col("source"),
    )


def q_null_blank_space_counts(spark, sf_dir):
    out = profile(docs_dirty(spark, sf_dir), frequencies_mode="none")
    return out.select("column_names", "num_rows", "num_null", "num_spaces", "num_blank", "count")


def q_profile_extremes(spark, sf_dir):
    """Most and least frequent values by pruning, for columns of few values and for unique ones."""
    li = table(spark, sf_dir, "lineitem").withColumn("l_comment_key", F.expr("concat(l_orderkey, '-', l_linenumber)"))
    wanted = ["l_returnflag", "l_linenumber", "l_suppkey", "l_shipdate", "l_orderkey", "l_extendedprice", "l_comment_key"]
    orders = orders_dirty(spark, sf_dir)
    return frequency_extremes(li, wanted).unionByName(frequency_extremes(orders, ["o_orderkey", "o_orderpriority", "o_custkey"]))


QUERIES = {
    "profile_extremes": q_profile_extremes,
    "profile_basic": q_profile_basic,
    "profile_frequencies": q_profile_frequencies,
    "profile_numeric": q_profile_numeric,
    "profile_sample_stats": q_profile_sample_stats,
    "profile_min_max": q_profile_min_max,
    "profile_types": q_profile_types,
    "profile_approx_distinct": q_profile_approx_distinct,
    "profile_percentiles": q_profile_percentiles,
    "profile_histogram": q_profile_histogram,
    "profile_histogram_wide": q_profile_histogram_wide,
    "null_blank_space_counts": q_null_blank_space_counts,
}
