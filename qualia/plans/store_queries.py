"""Registered queries for rule documents: selection (Q2, S3) and the rule store.

The rule catalogue is derived from ``customer`` (one document per account), so these
queries grow with the data like any other table operation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qualia.operators.rule_versions import RuleConflict, RuleVersions
from qualia.operators.rulestore import document_tasks, get_rule, put_rules, update_rules
from qualia.plans.common import table
from qualia.session import scratch_path
from qualia.sources.rules import rules_table, select_rules


def _vrule(spec, name, rule: Column, rtype, dim, slo: Column, active: Column) -> Column:
    return F.struct(
        F.lit(spec).alias("rule_specification"),
        F.lit(name).alias("rule_name"),
        rule.alias("rule"),
        F.lit(rtype).alias("rule_type"),
        F.lit(dim).alias("dimension"),
        slo.alias("slo"),
        active.cast("int").alias("is_active"),
        F.lit(None).cast("string").alias("check_level"),
    )


def _prule(dim, active, level, instance, rule, slo) -> Column:
    return F.struct(
        F.lit(dim).alias("dimension"),
        F.lit(active).cast("int").alias("is_active"),
        F.lit(level).cast("string").alias("check_level"),
        F.lit(instance).cast("string").alias("dimension_instance"),
        F.lit(rule).cast("string").alias("dimension_rule"),
        F.lit(slo).cast("string").alias("slo"),
    )


def account_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule document per customer account. Accounts are dealt out before their documents are made: a file's
    rows are a hundred times smaller."""
    c = table(spark, sf_dir, "customer")
    c = c.repartition(document_tasks(c))
    run_on = F.expr(
        "CASE c_mktsegment WHEN 'BUILDING' THEN array('cde') WHEN 'AUTOMOBILE' THEN array('kde') "
        "ELSE array('cde', 'kde') END"
    )
    validation = F.create_map(
        F.lit("c_custkey"),
        F.array(_vrule("Null Check", "custkey_not_null", F.lit("c_custkey is not null"), "non_aggregate",
                       "completeness", F.lit("gt(90)"), F.lit(1))),
        F.lit("c_acctbal"),
        F.array(_vrule("Range Check", "balance_floor",
                       F.concat(F.lit("c_acctbal >= "), F.floor("c_acctbal").cast("string")), "non_aggregate",
                       "validity", F.lit("ge(50)"), F.when(F.col("c_acctbal") > 0, 1).otherwise(0))),
        F.lit("C_NationKey"),
        F.array(_vrule("Range Check", "nation_known",
                       F.concat(F.lit("c_nationkey between 0 and "), F.col("c_nationkey").cast("string")),
                       "non_aggregate", "validity", F.lit("eq(100)"), F.lit(1))),
        F.lit("c_phone"),
        F.array(_vrule("Null Check", "phone_present", F.lit("c_phone is not null"), "non_aggregate",
                       "completeness", F.lit("gt(90)"), F.lit(1))),
    )
    profiler = F.create_map(
        F.lit("c_custkey"),
        F.array(_prule("Completeness", 1, "Error", None, None, None)),
        F.lit("c_mktsegment"),
        F.array(_prule("Compliance", 1, None, "segment_known", "c_mktsegment in ('BUILDING', 'AUTOMOBILE')",
                       "ge(0.4)")),
    )
    dataset = F.array(
        F.struct(
            F.lit("record_count").alias("rule_name"),
            F.lit("hasSize").alias("rule"),
            F.lit(1).alias("is_active"),
            F.lit("Error").alias("check_level"),
            F.concat(F.lit("gt("), F.col("c_nationkey").cast("string"), F.lit(")")).alias("service_level_objective"),
        )
    )
    return c.select(
        F.lower("c_mktsegment").alias("source"),
        F.concat(F.lit("account_"), F.col("c_custkey").cast("string")).alias("entity"),
        F.array(F.lit("c_custkey"), F.lit("c_acctbal")).alias("cde"),
        F.array(F.lit("c_nationkey"), F.lit("c_name")).alias("kde"),
        run_on.alias("rules_run_on"),
        F.lit("c_custkey").alias("primary_key"),
        validation.alias("single_column_validation_rules"),
        profiler.alias("single_column_profiler_rules"),
        dataset.alias("dataset_level_validation_rules"),
    )


def q_rule_selection(spark, sf_dir):
    rules = select_rules(rules_table(account_catalogue(spark, sf_dir)), kind=None)
    return rules.select(
        "source", "entity", "element", "level", "kind", "rule_name", "rule", "rule_type", "dimension",
        "check_level", "slo", "slo_op", "slo_value",
    )


def _summary(docs: DataFrame) -> DataFrame:
    """One row per document; rules as sorted text ``element/name/rule/slo``."""

    def rules(column: str, *fields: str) -> Column:
        entries = F.transform(F.map_entries(column), lambda e: F.transform(
            e["value"], lambda r: F.concat_ws("/", e["key"], *[F.coalesce(r[f], F.lit("-")) for f in fields])))
        return F.coalesce(F.array_join(F.array_sort(F.flatten(entries)), "; "), F.lit(""))

    return docs.select(
        "source",
        "entity",
        "primary_key",
        F.array_join("rules_run_on", ",").alias("run_on"),
        F.array_join("cde", ",").alias("cde"),
        rules("single_column_validation_rules", "rule_name", "rule", "slo").alias("validation"),
        rules("single_column_profiler_rules", "dimension", "check_level", "slo").alias("profiler"),
    )


def q_rules_get(spark, sf_dir):
    return _summary(get_rule(account_catalogue(spark, sf_dir), "furniture"))


def supplier_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.lit("supply").alias("source"),
        F.concat(F.lit("supplier_"), F.col("s_suppkey").cast("string")).alias("entity"),
        F.array(F.lit("s_suppkey")).alias("cde"),
        F.array().cast("array<string>").alias("kde"),
        F.array(F.lit("cde")).alias("rules_run_on"),
        F.lit("s_suppkey").alias("primary_key"),
        F.create_map(
            F.lit("s_suppkey"),
            F.array(_vrule("Null Check", "suppkey_not_null", F.lit("s_suppkey is not null"), "non_aggregate",
                           "completeness", F.lit("gt(90)"), F.lit(1))),
        ).alias("single_column_validation_rules"),
    )


def q_rules_upsert(spark, sf_dir):
    store = account_catalogue(spark, sf_dir)
    replaced = store.filter("source = 'household' AND entity LIKE 'account_1%'").select(
        "source", "entity",
        F.array(F.lit("c_name")).alias("cde"),
        F.array().cast("array<string>").alias("kde"),
        F.array(F.lit("cde")).alias("rules_run_on"),
        F.lit("c_name").alias("primary_key"),
    )
    batch = replaced.unionByName(supplier_documents(spark, sf_dir), allowMissingColumns=True).withColumn("version", F.lit(2))
    # an earlier version of each replaced document is in the same batch: the last one is written
    earlier = replaced.withColumn("primary_key", F.lit("outdated")).withColumn("version", F.lit(1))
    return _summary(put_rules(store, batch.unionByName(earlier, allowMissingColumns=True), order_col="version"))


def q_rules_update(spark, sf_dir):
    store = account_catalogue(spark, sf_dir)
    c = table(spark, sf_dir, "customer").filter("c_mktsegment = 'FURNITURE' AND c_acctbal > 5000")
    updates = c.select(
        F.lit("furniture").alias("source"),
        F.concat(F.lit("account_"), F.col("c_custkey").cast("string")).alias("entity"),
        F.create_map(
            F.lit("c_name"),
            F.array(_prule("Completeness", 1, "Warning", None, None, None)),
        ).alias("single_column_profiler_rules"),
        F.create_map(
            F.lit("c_name"),
            F.array(_vrule("Null Check", "name_not_null", F.lit("c_name is not null"), "non_aggregate",
                           "completeness", F.lit("gt(99)"), F.lit(1))),
            F.lit("c_acctbal"),
            F.array(_vrule("Range Check", "balance_positive", F.lit("c_acctbal > 0"), "non_aggregate",
                           "validity", F.lit("gt(50)"), F.lit(1))),
        ).alias("single_column_validation_rules"),
    )
    new_keys = supplier_documents(spark, sf_dir).select(
        "source", "entity",
        F.create_map(F.lit("s_suppkey"), F.array(_prule("Completeness", 1, None, None, None, None))).alias(
            "single_column_profiler_rules"),
        "single_column_validation_rules",
    )
    return _summary(update_rules(store, updates.unionByName(new_keys)))


def q_rules_versions(spark, sf_dir):
    """A published store: the catalogue is put, changed twice from the same version (the second change is
    refused), then read at each version."""
    store = RuleVersions(spark, scratch_path(spark, "rule-versions"))
    first = store.put(account_catalogue(spark, sf_dir))
    second = store.put(supplier_documents(spark, sf_dir), base=first)
    refused = 0
    try:
        store.put(supplier_documents(spark, sf_dir).withColumn("primary_key", F.lit("lost")), base=first)
    except RuleConflict:
        refused = 1
    third = store.update(supplier_documents(spark, sf_dir).where("entity LIKE '%1'"), base=second)
    out = None
    for version in (first, second, third):
        part = _summary(store.read(version)).withColumns({"version": F.lit(version), "refused": F.lit(refused)})
        out = part if out is None else out.unionByName(part)
    return out


QUERIES = {
    "rules_versions": q_rules_versions,
    "rule_selection": q_rule_selection,
    "rules_get": q_rules_get,
    "rules_upsert": q_rules_upsert,
    "rules_update": q_rules_update,
}
