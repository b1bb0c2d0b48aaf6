"""Regression tests for edge cases found in review."""

import json

import pytest
from pyspark.sql import functions as F

from qualia.operators.checks import Check, checks_from_rules, verify
from qualia.operators.metrics import Size, Uniqueness, metrics_from_config, run_metrics
from qualia.operators.rulestore import put_rules
from qualia.operators.suggest import suggest_constraints
from qualia.operators.validate import row_results, rule_metrics
from qualia.sources.rules import documents_from_dicts, read_rule_documents, rules_table, select_rules


def test_store_matches_rule_fields_by_name(spark):
    store = documents_from_dicts(spark, [{"source": "s", "entity": "e"}])
    # rule structs in another field order (as JSON with an inferred schema gives them)
    new = spark.createDataFrame([("s", "e")], "source string, entity string").select(
        "source", "entity",
        F.create_map(F.lit("x"), F.array(F.struct(
            F.lit("gt(90)").alias("slo"), F.lit("x > 0").alias("rule"), F.lit("pos").alias("rule_name"),
        ))).alias("single_column_validation_rules"),
    )
    r = put_rules(store, new).first().single_column_validation_rules["x"][0]
    assert (r.rule_name, r.rule, r.slo, r.rule_specification) == ("pos", "x > 0", "gt(90)", None)


def test_reserved_pass_through_names(survey):
    with pytest.raises(ValueError, match="clash"):
        row_results(survey, [{"element": "Age", "rule": "Age > 1", "rule_name": "a"}], pass_through=["state", "value"])


def test_mixed_rule_kinds(spark, survey):
    doc = {"source": "nhs", "entity": "p", "cde": ["patient_id"], "rules_run_on": ["cde"],
           "single_column_validation_rules": {"patient_id": [
               {"rule_name": "pid", "rule": "patient_id is not null", "dimension": "completeness", "slo": "gt(90)"},
               {"rule": "patient_id > 0"}]},
           "single_column_profiler_rules": {"patient_id": [{"dimension": "CountDistinct", "is_active": 1},
                                                           {"dimension": "Completeness", "is_active": 1}]}}
    rules = select_rules(rules_table(documents_from_dicts(spark, [doc])), kind=None)
    names = sorted(r.rule_name for r in rule_metrics(survey, rules).collect())
    assert names == ["patient_id > 0", "pid"]  # profiler rules are not rule metrics
    checks = checks_from_rules(rules)  # CountDistinct without an objective: measured, not checked
    assert [c.text for ch in checks for c in ch.constraints] == [
        "CompletenessConstraint(Completeness(patient_id,None))"]


def test_empty_and_degenerate_inputs(spark, survey):
    empty = spark.createDataFrame([], "a long, b string")
    assert suggest_constraints(empty).count() == 0
    assert suggest_constraints(survey, rules=()).count() == 0
    arr = spark.createDataFrame([([1], 1)], "arr array<int>, x int")
    reported = {r.name: r.error for r in run_metrics(arr, [Size(), Uniqueness("arr")], on_error="report").collect()}
    assert reported["Size"] is None and "complex" in reported["Uniqueness"]
    rows = verify(survey, [Check("Error", "c").isComplete("nope")]).collect()
    assert rows[0].constraint_status == "Failure" and "null" in rows[0].constraint_message
    assert metrics_from_config(survey, [{"rule_name": "completeness", "on_columns": None},
                                        {"rule_name": "size", "on_columns": ["*"]}]).count() == 1


def test_non_negative_and_data_type_checks(spark):
    df = spark.createDataFrame([(1, "1"), (2, "x"), (None, "3")], "n int, t string")
    rows = {r.constraint: r.constraint_status for r in verify(df, [
        Check("Error", "c").isNonNegative("n").hasDataType("t", "Integral", "ge(0.6)")]).collect()}
    assert list(rows.values()) == ["Success", "Success"]


def test_flat_document_with_empty_entities(spark, tmp_path):
    p = tmp_path / "d.json"
    p.write_text(json.dumps({"source": "s", "entity": "e", "cde": ["a"], "rules_run_on": ["cde"], "entities": [],
                             "single_column_validation_rules": {"a": [{"rule_name": "r", "rule": "a > 0"}]}}))
    assert read_rule_documents(spark, str(p)).count() == 1
