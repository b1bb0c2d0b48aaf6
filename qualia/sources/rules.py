"""Rule documents (S3) and the canonical one-row-per-rule table.

A rule document is keyed by ``(source, entity)`` and lists critical (``cde``) and key
(``kde``) data elements, which element groups rules run on, and per-element rule lists.
Documents are a DataFrame; they are flattened with ``explode``/``inline`` only, so a
catalogue of any size stays distributed.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualia.functions.predicates import slo_parts

VALIDATION_RULE = T.StructType(
    [
        T.StructField("rule_specification", T.StringType()),
        T.StructField("rule_name", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("rule_type", T.StringType()),
        T.StructField("dimension", T.StringType()),
        T.StructField("slo", T.StringType()),
        T.StructField("is_active", T.IntegerType()),
        T.StructField("check_level", T.StringType()),
    ]
)

PROFILER_RULE = T.StructType(
    [
        T.StructField("dimension", T.StringType()),
        T.StructField("is_active", T.IntegerType()),
        T.StructField("check_level", T.StringType()),
        T.StructField("dimension_instance", T.StringType()),
        T.StructField("dimension_rule", T.StringType()),
        T.StructField("slo", T.StringType()),
    ]
)

DATASET_RULE = T.StructType(
    [
        T.StructField("rule_name", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("is_active", T.IntegerType()),
        T.StructField("check_level", T.StringType()),
        T.StructField("service_level_objective", T.StringType()),
    ]
)

DOCUMENT_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("entity", T.StringType()),
        T.StructField("cde", T.ArrayType(T.StringType())),
        T.StructField("kde", T.ArrayType(T.StringType())),
        T.StructField("rules_run_on", T.ArrayType(T.StringType())),
        T.StructField("primary_key", T.StringType()),
        T.StructField("single_column_validation_rules", T.MapType(T.StringType(), T.ArrayType(VALIDATION_RULE))),
        T.StructField("single_column_profiler_rules", T.MapType(T.StringType(), T.ArrayType(PROFILER_RULE))),
        T.StructField("dataset_level_validation_rules", T.ArrayType(DATASET_RULE)),
    ]
)

RULES_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("entity", T.StringType()),
        T.StructField("element", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("rule_name", T.StringType()),
        T.StructField("rule_specification", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("rule_type", T.StringType()),
        T.StructField("dimension", T.StringType()),
        T.StructField("check_level", T.StringType()),
        T.StructField("slo", T.StringType()),
        T.StructField("slo_op", T.StringType()),
        T.StructField("slo_value", T.DoubleType()),
        T.StructField("is_active", T.IntegerType()),
        T.StructField("in_scope", T.BooleanType()),
    ]
)


GROUPED_PROFILER_RULE = T.StructType(
    [T.StructField("rule_name", T.StringType()), T.StructField("on_columns", T.ArrayType(T.StringType()))]
)
GROUPED_VALIDATION_RULE = T.StructType(
    [
        T.StructField("rule_specification", T.StringType()),
        T.StructField("rule_name", T.StringType()),
        T.StructField("rule", T.StringType()),
    ]
)
ENTITY_SCHEMA = T.StructType(
    [f for f in DOCUMENT_SCHEMA.fields if f.name != "source"]
    + [
        T.StructField("run_rules_on", T.ArrayType(T.StringType())),
        # profiler rules listed per element group: {"cde": [{rule_name, on_columns[]}], ...}
        T.StructField("profiler_rules", T.MapType(T.StringType(), T.ArrayType(GROUPED_PROFILER_RULE))),
        T.StructField("validation_rules", T.MapType(T.StringType(), T.ArrayType(GROUPED_VALIDATION_RULE))),
    ]
)
FILE_SCHEMA = T.StructType(DOCUMENT_SCHEMA.fields + [T.StructField("entities", T.ArrayType(ENTITY_SCHEMA))])


def read_rule_documents(spark: SparkSession, path: str, multi_line: bool = True, mode: str = "FAILFAST") -> DataFrame:
    """JSON rule documents with the canonical schema.

    ``multi_line=True`` (default): each file holds one document or a JSON array of
    documents, pretty-printed or not; ``multi_line=False``: JSON Lines, one document per line.

    Two layouts are accepted: flat documents keyed by ``source``/``entity``, and files with
    a top-level ``source`` and a list of ``entities`` (using ``run_rules_on`` or
    ``rules_run_on``, and profiler rules either per column or as ``{rule_name,
    on_columns[]}`` lists per element group). Missing fields read as null; unknown
    fields are ignored. Rules listed per element group apply when the document runs rules on
    that group; a validation rule listed so names no element: its element is the group's
    column that the rule text mentions first (its first column otherwise).

    A malformed document fails the read (``mode``; see ``malformed_documents``).
    """
    raw = spark.read.schema(FILE_SCHEMA).option("multiLine", str(bool(multi_line)).lower()).option("mode", mode).json(path)
    is_nested = F.coalesce(F.size("entities") > 0, F.lit(False))
    flat = raw.filter(~is_nested).select(*[f.name for f in DOCUMENT_SCHEMA.fields])
    nested = raw.filter(is_nested).select(
        F.col("source").alias("_source"), F.explode("entities").alias("e")
    ).select("_source", "e.*")
    return flat.unionByName(_entities_to_documents(nested))


def malformed_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """``file, record`` of the files (``multi_line``) or lines that are not JSON, which
    ``read_rule_documents`` refuses."""
    raw = spark.read.option("wholetext", str(bool(multi_line)).lower()).text(path)
    raw = raw.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("record"))
    return raw.where(F.try_parse_json("record").isNull() & (F.trim("record") != ""))


def _grouped_validation() -> Column:
    """Validation rules listed per element group, as a map element -> rules (null without any)."""
    none = F.array().cast("array<string>")
    run_on = F.coalesce(F.col("rules_run_on"), F.col("run_rules_on"), none)
    groups = F.filter(F.map_entries("validation_rules"), lambda g: F.array_contains(run_on, g["key"]))

    def element(names: Column, rule: Column) -> Column:
        # position of each of the group's names in the rule text; the earliest one wins
        found = F.transform(names, lambda n: F.struct(F.instr(F.lower(rule), F.lower(n)).alias("at"), (-F.length(n)).alias("len"), n.alias("name")))
        first = F.array_min(F.filter(found, lambda x: x["at"] > 0))
        return F.coalesce(first["name"], F.get(names, F.lit(0)))

    def pairs_of(g: Column) -> Column:
        # a group may name columns of the other group: all the document's elements are looked for
        own = F.when(g["key"] == "kde", F.coalesce("kde", none)).otherwise(F.coalesce("cde", none))
        names = F.array_distinct(F.concat(own, F.coalesce("cde", none), F.coalesce("kde", none)))
        return F.transform(g["value"], lambda r: F.struct(
            element(names, r["rule"]).alias("col"),
            F.struct(
                r["rule_specification"].alias("rule_specification"), r["rule_name"].alias("rule_name"), r["rule"].alias("rule"),
                F.lit(None).cast("string").alias("rule_type"), F.lit(None).cast("string").alias("dimension"),
                F.lit(None).cast("string").alias("slo"), F.lit(1).alias("is_active"), F.lit(None).cast("string").alias("check_level"),
            ).alias("rule")))

    pairs = F.filter(F.flatten(F.transform(groups, pairs_of)), lambda p: p["col"].isNotNull())
    cols = F.array_distinct(F.transform(pairs, lambda p: p["col"]))
    by_col = F.map_from_arrays(
        cols, F.transform(cols, lambda c: F.array_distinct(F.transform(F.filter(pairs, lambda p: p["col"] == c), lambda p: p["rule"]))))
    return F.when(F.size(pairs) > 0, by_col)


def _entities_to_documents(ents: DataFrame) -> DataFrame:
    """Entity records (one per row, with ``_source``) -> canonical documents, per row only."""
    run_on = F.coalesce(F.col("rules_run_on"), F.col("run_rules_on"), F.array().cast("array<string>"))
    listed = F.map_filter(
        F.coalesce(F.col("profiler_rules"), F.create_map().cast(ENTITY_SCHEMA["profiler_rules"].dataType)),
        lambda group, _: F.array_contains(run_on, group))
    # {group: [{rule_name, on_columns}]} -> [(column, profiler rule)] -> map column -> rules
    pairs = F.flatten(
        F.transform(
            F.map_values(listed),
            lambda rules: F.flatten(
                F.transform(
                    rules,
                    lambda r: F.transform(
                        F.coalesce(r["on_columns"], F.array().cast("array<string>")),
                        lambda c: F.struct(
                            c.alias("col"),
                            F.struct(
                                r["rule_name"].alias("dimension"),
                                F.lit(1).alias("is_active"),
                                F.lit(None).cast("string").alias("check_level"),
                                F.lit(None).cast("string").alias("dimension_instance"),
                                F.lit(None).cast("string").alias("dimension_rule"),
                                F.lit(None).cast("string").alias("slo"),
                            ).alias("rule"),
                        ),
                    ),
                )
            ),
        )
    )
    cols = F.array_distinct(F.transform(pairs, lambda p: p["col"]))
    grouped = F.map_from_arrays(
        cols,
        F.transform(cols, lambda c: F.array_distinct(F.transform(F.filter(pairs, lambda p: p["col"] == c), lambda p: p["rule"]))),
    )
    profiler = F.when(F.col("single_column_profiler_rules").isNotNull(), F.col("single_column_profiler_rules")).when(
        F.size(pairs) > 0, grouped
    )
    return ents.select(
        F.col("_source").alias("source"),
        "entity",
        "cde",
        "kde",
        F.coalesce(F.col("rules_run_on"), F.col("run_rules_on")).alias("rules_run_on"),
        "primary_key",
        F.coalesce(
            F.col("single_column_validation_rules"),
            _grouped_validation().cast(DOCUMENT_SCHEMA["single_column_validation_rules"].dataType),
        ).alias("single_column_validation_rules"),
        profiler.cast(DOCUMENT_SCHEMA["single_column_profiler_rules"].dataType).alias("single_column_profiler_rules"),
        "dataset_level_validation_rules",
    )


def documents_from_dicts(spark: SparkSession, docs: Iterable[Mapping]) -> DataFrame:
    """Documents written as Python dicts (the in-code form), typed with the canonical schema."""
    rows = []
    for d in docs:
        row = {f.name: d.get(f.name) for f in DOCUMENT_SCHEMA.fields}
        for key, struct in (
            ("single_column_validation_rules", VALIDATION_RULE),
            ("single_column_profiler_rules", PROFILER_RULE),
        ):
            m = row[key]
            if isinstance(m, Mapping):
                row[key] = {
                    el: [{f.name: r.get(f.name) for f in struct.fields} for r in (rs or [])] for el, rs in m.items()
                }
            else:
                row[key] = None
        ds = row["dataset_level_validation_rules"]
        row["dataset_level_validation_rules"] = (
            [{f.name: r.get(f.name) for f in DATASET_RULE.fields} for r in ds] if ds else None
        )
        rows.append(row)
    return spark.createDataFrame(rows, DOCUMENT_SCHEMA)


def _in_scope(element: Column) -> Column:
    """Element listed in ``cde`` (when rules run on cde) or ``kde`` (when rules run on kde).

    Names compare case-insensitively, as Spark resolves columns.
    """
    low = F.lower(element)
    run_on = F.coalesce(F.col("rules_run_on"), F.array().cast("array<string>"))

    def listed(group: str) -> Column:
        names = F.transform(F.coalesce(F.col(group), F.array().cast("array<string>")), lambda x: F.lower(x))
        return F.array_contains(run_on, F.lit(group)) & F.array_contains(names, low)

    return F.coalesce(listed("cde") | listed("kde"), F.lit(False))


def rules_table(documents: DataFrame) -> DataFrame:
    """Flatten documents into the canonical rules table (one row per rule).

    Validation rules keep their ``rule_type`` (default ``non_aggregate``); profiler rules
    become ``kind='profile'`` rows whose ``rule`` is the metric name (or the compliance
    predicate); dataset-level rules have ``element='*'`` and are always in scope.
    """
    doc_cols = ["source", "entity", "cde", "kde", "rules_run_on"]
    validation = (
        documents.select(*doc_cols, F.explode("single_column_validation_rules").alias("element", "rs"))
        .select(*doc_cols, "element", F.inline("rs"))
        .select(
            "source",
            "entity",
            "element",
            F.lit("column").alias("level"),
            F.lit("validation").alias("kind"),
            "rule_name",
            "rule_specification",
            "rule",
            F.coalesce(F.col("rule_type"), F.lit("non_aggregate")).alias("rule_type"),
            "dimension",
            "check_level",
            "slo",
            F.col("is_active"),
            _in_scope(F.col("element")).alias("in_scope"),
        )
    )
    profile = (
        documents.select(*doc_cols, F.explode("single_column_profiler_rules").alias("element", "rs"))
        .select(*doc_cols, "element", F.inline("rs"))
        .select(
            "source",
            "entity",
            "element",
            F.lit("column").alias("level"),
            F.lit("profile").alias("kind"),
            F.coalesce(F.col("dimension_instance"), F.concat_ws("_", "element", F.lower("dimension"))).alias(
                "rule_name"
            ),
            F.col("dimension").alias("rule_specification"),
            F.coalesce(F.col("dimension_rule"), F.col("dimension")).alias("rule"),
            F.lit("aggregate").alias("rule_type"),
            "dimension",
            "check_level",
            "slo",
            F.col("is_active"),
            _in_scope(F.col("element")).alias("in_scope"),
        )
    )
    dataset = documents.select("source", "entity", F.inline("dataset_level_validation_rules")).select(
        "source",
        "entity",
        F.lit("*").alias("element"),
        F.lit("dataset").alias("level"),
        F.lit("validation").alias("kind"),
        "rule_name",
        F.col("rule").alias("rule_specification"),
        "rule",
        F.lit("aggregate").alias("rule_type"),
        F.lit("size").alias("dimension"),
        "check_level",
        F.col("service_level_objective").alias("slo"),
        F.col("is_active"),
        F.lit(True).alias("in_scope"),
    )
    out = validation.unionByName(profile).unionByName(dataset)
    op, bound = slo_parts(F.col("slo"))
    return out.select(
        "source",
        "entity",
        "element",
        "level",
        "kind",
        "rule_name",
        "rule_specification",
        "rule",
        "rule_type",
        "dimension",
        "check_level",
        "slo",
        op.alias("slo_op"),
        bound.alias("slo_value"),
        F.coalesce(F.col("is_active"), F.lit(1)).cast("int").alias("is_active"),
        "in_scope",
    )


def select_rules(rules: DataFrame, kind: str | None = "validation") -> DataFrame:
    """Rules that run: element in scope (cde/kde by ``rules_run_on``), active, of ``kind``."""
    cond = F.col("in_scope") & (F.col("is_active") == 1)
    if kind is not None:
        cond = cond & (F.col("kind") == kind)
    return rules.filter(cond)


_CONFIGURED: dict[str, list[dict]] = {}


def rules_of(spark: SparkSession, docs: Iterable[Mapping], kind: str | None = "validation") -> list[dict]:
    """The rules that run of documents written as Python dicts, through ``rules_table`` and
    ``select_rules`` (configuration in code: the rules are read to be compiled into a plan).
    Equal documents have equal rules, so each is flattened once per process."""
    docs = list(docs)
    key = json.dumps([docs, kind], sort_keys=True)
    if key not in _CONFIGURED:
        _CONFIGURED[key] = [r.asDict() for r in select_rules(rules_table(documents_from_dicts(spark, docs)), kind).collect()]
    return [dict(r) for r in _CONFIGURED[key]]
