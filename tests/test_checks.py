"""Checks and suggestions on parcels, and the recorded texts of the library's results."""

import pytest
from pyspark.sql import functions as F

from qualia.functions.predicates import ge, gt
from qualia.operators.checks import Check, CheckLevel, VerificationSuite, checks_from_rules, verify
from qualia.operators.metrics import profile_rule_metrics
from qualia.operators.suggest import suggest_constraints
from qualia.sources.rules import rules_of

PARCELS = [(i, "red" if i % 4 else "blue", None if i % 5 == 0 else i * 0.5, str(i % 3), f"p{i // 2}") for i in range(40)]


@pytest.fixture(scope="module")
def parcels(spark):
    return spark.createDataFrame(PARCELS, "id long, colour string, weight double, zone string, pallet string")


def results(out):
    return {r.constraint: (r.constraint_status, r.constraint_message) for r in out.collect()}


# Texts that the recorded output shows for a metric of 8/9, of 0.5 and of 9 rows.
TEXT = "Value: {} does not meet the constraint requirement!"


def test_recorded_texts(recorded):
    out = results(verify(recorded, [
        Check(CheckLevel.Warning, "ids").isUnique("patient_id").hasCompleteness("patient_id", gt(0.95)).hasSize("gt(20)", "too few")]))
    assert out == {
        "UniquenessConstraint(Uniqueness(List(patient_id),None))": ("Failure", TEXT.format(0.5)),
        "CompletenessConstraint(Completeness(patient_id,None))": ("Failure", TEXT.format(0.8888888888888888)),
        "SizeConstraint(Size(None))": ("Failure", TEXT.format(9) + " too few"),
    }


def test_levels_and_tags(parcels):
    strict = Check(CheckLevel.Error, "strict").isComplete("weight").isComplete("id")
    mild = Check(CheckLevel.Warning, "mild").isContainedIn("colour", ["red", "blue"]).hasUniqueness(["id", "zone"], "eq(1)")
    rows = VerificationSuite(parcels).addCheck(mild).addCheck(strict).run({"site": "depot"}).collect()
    assert [(r.check, r.check_status, r.constraint_status, r.site) for r in rows] == [
        ("mild", "Success", "Success", "depot"), ("mild", "Success", "Success", "depot"),
        ("strict", "Error", "Failure", "depot"), ("strict", "Error", "Success", "depot")]
    assert rows[2].constraint_message == TEXT.format(0.8) and rows[3].constraint_message == ""


def test_constraint_kinds(parcels):
    check = (
        Check(CheckLevel.Error, "kinds").isNonNegative("weight").hasDataType("zone", "Integral").hasDataType("pallet", "Integral", "lt(0.1)")
        .hasDistinctness(["pallet"], ("ge", 0.5)).hasNumberOfDistinctValues("zone", "eq(3)").satisfies("id < 30", "low_ids", ge(0.75))
        .satisfies("weight > 1", "heavy", gt(0.9), "weigh again", where="colour = 'blue'")
    )
    out = verify(parcels, [check]).collect()
    assert [r.constraint_status for r in out] == ["Success"] * 6 + ["Failure"]
    assert out[6].constraint == "ComplianceConstraint(Compliance(heavy,weight > 1,Some(colour = 'blue')))"
    assert out[6].constraint_message.endswith("weigh again")


def test_a_metric_that_cannot_be_computed_fails_with_its_reason(parcels):
    (row,) = verify(parcels, [Check(CheckLevel.Error, "c").isComplete("postcode")]).collect()
    assert row.constraint_status == "Failure" and row.constraint_message.startswith(TEXT.format("null"))
    assert "postcode" in row.constraint_message


def test_equal_metrics_are_computed_once(parcels):
    check = Check(CheckLevel.Error, "same").isComplete("id").hasCompleteness("id", ge(0.1)).isComplete("id")
    assert verify(parcels, [check])._jdf.queryExecution().optimizedPlan().toString().count("count(if") <= 2


def test_suggestions(parcels):
    rows = suggest_constraints(parcels).collect()
    got = {(r.column_name, r.constraint) for r in rows}
    assert got == {
        ("id", "isComplete"), ("colour", "isComplete"), ("zone", "isComplete"), ("pallet", "isComplete"), ("id", "isUnique"),
        ("weight", "hasCompleteness"), ("zone", "hasDataType"), ("colour", "isContainedIn"), ("zone", "isContainedIn"),
        ("id", "isNonNegative"), ("weight", "isNonNegative"),
    }
    for r in rows:  # predicates hold for every row
        if r.predicate:
            assert parcels.where(~F.expr(r.predicate)).count() == 0
    cuts = suggest_constraints(parcels, categorical_ratio=0.05, least_completeness=0.9)
    assert not {("weight", "hasCompleteness"), ("zone", "isContainedIn")} & {(r.column_name, r.constraint) for r in cuts.collect()}


def test_suggestions_escape_values(spark):
    odd = ['a"b', "c'd", "e\\f"]
    df = spark.createDataFrame([(odd[i % 3],) for i in range(60)], '`q"c` string')
    (row,) = suggest_constraints(df, rules=["categorical_range"]).collect()
    assert row.code_for_constraint == '.isContainedIn("q\\"c", ["a\\"b", "c\'d", "e\\\\f"])'
    assert df.where(F.expr(row.predicate)).count() == 60


DOC = {
    "source": "depot", "entity": "parcels", "cde": ["id"], "kde": ["colour", "zone"], "rules_run_on": ["cde", "kde"],
    "dataset_level_validation_rules": [{"rule_name": "arrivals", "rule": "hasSize", "check_level": "Error", "service_level_objective": "ge(50)"}],
    "single_column_profiler_rules": {
        "id": [{"dimension": "Uniqueness", "check_level": "Error"}, {"dimension": "Completeness"}],
        "colour": [{"dimension": "Compliance", "dimension_instance": "mostly_red", "dimension_rule": "colour = 'red'", "slo": "gt(0.7)"}],
        "zone": [{"dimension": "CountDistinct", "slo": "le(2)"}, {"dimension": "Distinctness", "is_active": 0}],
        "weight": [{"dimension": "Completeness"}],
    },
}


def test_profiler_rules_as_metrics_and_checks(spark, parcels):
    rules = rules_of(spark, [DOC], kind=None)
    metrics = {(r.instance, r.name): r.value for r in profile_rule_metrics(parcels, rules).collect()}
    assert metrics == {("*", "Size"): 40.0, ("id", "Uniqueness"): 1.0, ("id", "Completeness"): 1.0,
                       ("mostly_red", "Compliance"): 0.75, ("zone", "CountDistinct"): 3.0}
    status = {r.constraint.split("(")[0]: (r.check_level, r.check_status, r.constraint_status)
              for r in verify(parcels, checks_from_rules(rules)).collect()}
    assert status == {
        "SizeConstraint": ("Error", "Error", "Failure"), "UniquenessConstraint": ("Error", "Error", "Success"),
        "CompletenessConstraint": ("Warning", "Warning", "Success"), "ComplianceConstraint": ("Warning", "Warning", "Success"),
        "CountDistinctConstraint": ("Warning", "Warning", "Failure"),
    }
