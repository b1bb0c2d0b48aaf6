"""Registered queries for sources, basic operators, format checks and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualia.functions.predicates import FULL_TIMESTAMP_REGEX, format_check, matches
from qualia.operators.basic import count_by
from qualia.operators.metrics import CountDistinct, Mean, Size, run_metrics
from qualia.operators.reconcile import differences, reconcile_from_mapping
from qualia.operators.results import history, read_results, write_results
from qualia.plans.common import RUN_TS, table
from qualia.session import scratch_path
from qualia.sources.files import quarantine, read_csv, read_csv_checked


def q_group_count_filtered(spark, sf_dir):
    return count_by(table(spark, sf_dir, "customer"), "c_mktsegment", where="c_acctbal < 5000")


def q_csv_roundtrip_count(spark, sf_dir):
    """Write customer as CSV to the shared scratch folder, read it back with an
    inferred schema, then count low-balance customers per segment."""
    path = scratch_path(spark, "csv_roundtrip")
    table(spark, sf_dir, "customer").write.option("header", "true").csv(path)
    return count_by(read_csv(spark, path), "c_mktsegment", where="c_acctbal < 5000")


def orders_timestamp_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text; low-priority rows day-first, urgent rows without seconds."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.expr(
            "CASE WHEN o_orderpriority = '5-LOW' THEN date_format(o_orderdate, 'dd-MM-yyyy HH:mm:ss') "
            "WHEN o_orderpriority = '1-URGENT' THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm') "
            "ELSE CAST(o_orderdate AS STRING) END"
        ).alias("ts_text"),
    )


def q_regex_check(spark, sf_dir):
    df = orders_timestamp_text(spark, sf_dir)
    return df.select("o_orderkey", "ts_text", matches(F.col("ts_text"), FULL_TIMESTAMP_REGEX).alias("date_format1"))


def q_timestamp_format_check(spark, sf_dir):
    df = orders_timestamp_text(spark, sf_dir)
    return df.select("o_orderkey", format_check(F.col("ts_text"), "yyyy-MM-dd HH:mm:ss").alias("format_ok"))


ACCOUNTS_MAPPING = {
    "src": "crm",
    "entity": "account",
    "external_entity": "registry",
    "source_primary_key": "account_id",
    "primary_key_mapping": "registration_no=company_no",
    "src_ext_mapping": [
        "business_name=business_name",
        "registration_dt=registered_on",
        "country=registered_country",
    ],
}


def accounts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Source accounts and an external registry derived from customer and nation.

    Source: customers with a non-negative balance (registry-only keys come from the
    others); registration number null for nation 0; names missing for HOUSEHOLD.
    Registry: no MACHINERY customers (source-only keys); names upper-cased for balances
    above 9000; BUILDING dates a day later; AUTOMOBILE countries missing.
    """
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cn = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    base_date = F.expr("date_add(DATE '2000-01-01', c_nationkey * 30)")
    src = cn.filter("c_acctbal >= 0").select(
        F.col("c_custkey").alias("account_id"),
        F.expr("CASE WHEN c_nationkey = 0 THEN NULL ELSE c_custkey + 1000000 END").alias("registration_no"),
        F.expr("CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_name END").alias("business_name"),
        base_date.alias("registration_dt"),
        F.col("n_name").alias("country"),
    )
    ext = cn.filter("c_mktsegment <> 'MACHINERY'").select(
        (F.col("c_custkey") + 1000000).alias("company_no"),
        F.expr("CASE WHEN c_acctbal > 9000 THEN upper(c_name) ELSE c_name END").alias("business_name"),
        F.expr("date_add(date_add(DATE '2000-01-01', c_nationkey * 30), "
               "CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END)").alias("registered_on"),
        F.expr("CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL ELSE n_name END").alias("registered_country"),
        F.lit("2020-01-31").cast("date").alias("publish_date"),
    )
    return src, ext


def q_reconcile_accounts(spark, sf_dir):
    src, ext = accounts(spark, sf_dir)
    return reconcile_from_mapping(src, ext, ACCOUNTS_MAPPING, run_ts=RUN_TS)


def q_reconcile_unmatched(spark, sf_dir):
    src, ext = accounts(spark, sf_dir)
    return differences(reconcile_from_mapping(src, ext, ACCOUNTS_MAPPING, run_ts=RUN_TS))


SHIPMENTS_MAPPING = {
    "external_entity": "carrier",
    "source_primary_key": ["order_no", "line_no"],
    "primary_key_mapping": ["order_no=consignment", "line_no=position", "region<=>depot"],
    "src_ext_mapping": ["quantity=pieces", "shipped=dispatched"],
}


def shipments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Order lines and a carrier's list of them, keyed by order, line and a region that is unknown for
    some lines on both sides (null matches null), on one side for others (they do not match). The
    carrier lacks tenth lines, renumbers some, and counts pieces as text."""
    li = table(spark, sf_dir, "lineitem")
    src = li.where("l_linenumber % 7 <> 3").selectExpr(
        "l_orderkey AS order_no", "CASE WHEN l_partkey % 50 = 0 THEN NULL ELSE l_linenumber END AS line_no",
        "CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE l_returnflag END AS region",
        "CAST(l_quantity AS INT) AS quantity", "CAST(l_shipdate AS DATE) AS shipped")
    ext = li.where("l_partkey % 10 <> 1").selectExpr(
        "CAST(l_orderkey AS STRING) AS consignment", "CAST(l_linenumber AS BIGINT) AS position",
        "CASE WHEN l_suppkey % 3 = 0 OR l_suppkey % 7 = 0 THEN NULL ELSE l_returnflag END AS depot",
        "CAST(CAST(l_quantity + IF(l_tax > 0.07, 1, 0) AS INT) AS STRING) AS pieces", "date_add(CAST(l_shipdate AS DATE), 2) AS dispatched",
        "DATE '2020-01-31' AS publish_date")
    return src, ext


def q_reconcile_composite(spark, sf_dir):
    """Reconciliation on three key parts of different types, one of which matches null with null."""
    src, ext = shipments(spark, sf_dir)
    return reconcile_from_mapping(src, ext, SHIPMENTS_MAPPING, run_ts=RUN_TS)


def q_csv_quarantine(spark, sf_dir):
    """Customers as CSV lines, some with a word for a number, too few or too many fields; every line is
    either a typed row or refused with its reasons."""
    path = scratch_path(spark, "csv_broken")
    line = F.concat_ws(
        ",", F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 11 == 0, F.lit("")).otherwise(F.col("c_name")),
        F.when(F.col("c_custkey") % 10 == 0, F.lit("n/a")).otherwise(F.col("c_nationkey").cast("string")),
        F.when(F.col("c_custkey") % 15 == 0, F.lit("many")).otherwise(F.col("c_acctbal").cast("string")))
    line = F.when(F.col("c_custkey") % 21 == 0, F.concat(line, F.lit(",extra"))).when(F.col("c_custkey") % 26 == 0, F.substring_index(line, ",", 2)).otherwise(line)
    table(spark, sf_dir, "customer").select(line.alias("value")).write.text(path)
    checked = read_csv_checked(spark, path, "custkey long, name string, nation int, balance double", header="false")
    good, refused = quarantine(checked, scratch_path(spark, "csv_quarantine"))
    return good.select("custkey", "name", "nation", "balance", F.lit("").alias("errors")).unionByName(
        refused.select(
            F.coalesce(F.get_json_object("_record", "$.custkey"), F.substring_index("_record", ",", 1)).cast("long").alias("custkey"),
            F.lit(None).cast("string").alias("name"), F.lit(None).cast("int").alias("nation"), F.lit(None).cast("double").alias("balance"),
            F.array_join("_errors", "; ").alias("errors")))


def q_results_history(spark, sf_dir):
    """Metrics of orders up to a year stored as runs, one run twice and with more columns later, and
    each value beside that of the run before."""
    path = scratch_path(spark, "results")
    orders = table(spark, sf_dir, "orders")
    for year, run in ((1996, "run-1"), (1997, "run-2"), (2000, "run-3"), (1998, "run-2")):
        found = run_metrics(orders.where(F.year("o_orderdate") <= year), [Size(), Mean("o_totalprice"), CountDistinct("o_custkey")])
        write_results(found if run == "run-1" else found.withColumn("until", F.lit(year)), path, run)
    out = history(read_results(spark, path), ["entity", "instance", "name"])
    rounded = {c: F.round(c, 4) for c in ("value", "previous", "change")}
    return out.withColumns(rounded).select("run_id", "run_number", "instance", "name", "value", "previous", "change", "until")


QUERIES = {
    "csv_quarantine": q_csv_quarantine,
    "results_history": q_results_history,
    "reconcile_composite": q_reconcile_composite,
    "group_count_filtered": q_group_count_filtered,
    "csv_roundtrip_count": q_csv_roundtrip_count,
    "regex_check": q_regex_check,
    "timestamp_format_check": q_timestamp_format_check,
    "reconcile_accounts": q_reconcile_accounts,
    "reconcile_unmatched": q_reconcile_unmatched,
}
