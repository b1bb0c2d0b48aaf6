from pyspark.sql import functions as F

from qualia.operators.rulestore import get_rule, put_rules, update_rules
from qualia.sources.rules import documents_from_dicts

V = {"patient_id": [{"rule_name": "patient_id_isnull", "rule": "patient_id is not null", "is_active": 1}]}


def store(spark):
    return documents_from_dicts(spark, [
        {"source": "nhs", "entity": "patient", "cde": ["patient_id"], "kde": [], "rules_run_on": ["cde"],
         "single_column_validation_rules": V},
        {"source": "nhs", "entity": "gp", "cde": [], "kde": ["gp_id"], "rules_run_on": ["kde"]},
    ])


def test_get(spark):
    assert get_rule(store(spark), "nhs", "patient").count() == 1
    assert get_rule(store(spark), "nhs").count() == 2
    assert get_rule(store(spark), "nhs", "missing").count() == 0


def test_put_replaces_whole_document(spark):
    new = documents_from_dicts(spark, [{"source": "nhs", "entity": "patient", "cde": ["age"]},
                                       {"source": "sse", "entity": "account", "cde": ["id"]}])
    out = {(r.source, r.entity): r for r in put_rules(store(spark), new).collect()}
    assert len(out) == 3
    assert out[("nhs", "patient")].cde == ["age"]
    assert out[("nhs", "patient")].single_column_validation_rules is None  # whole item replaced


def test_update_sets_three_attributes(spark):
    upd = documents_from_dicts(spark, [{"source": "nhs", "entity": "gp", "single_column_validation_rules": V},
                                       {"source": "new", "entity": "x", "single_column_validation_rules": V}])
    out = {(r.source, r.entity): r for r in update_rules(store(spark), upd).collect()}
    gp = out[("nhs", "gp")]
    assert gp.rules_run_on == ["cde", "kde"] and gp.kde == ["gp_id"]
    assert gp.single_column_validation_rules["patient_id"][0].rule_name == "patient_id_isnull"
    assert out[("nhs", "patient")].rules_run_on == ["cde"]
    assert out[("new", "x")].cde is None


def test_the_last_document_of_a_key_wins(spark):
    batch = documents_from_dicts(spark, [
        {"source": "nhs", "entity": "gp", "primary_key": "first"}, {"source": "nhs", "entity": "gp", "primary_key": "second"},
        {"source": "new", "entity": "x", "primary_key": "a"}, {"source": "new", "entity": "x", "primary_key": "b"}])
    batch = batch.withColumn("version", F.when(F.col("primary_key").isin("second", "a"), 2).otherwise(1))
    for docs in (batch, batch.orderBy("primary_key"), batch.orderBy(F.desc("primary_key"))):
        out = {(r.source, r.entity): r.primary_key for r in put_rules(store(spark), docs, order_col="version").collect()}
        assert out == {("nhs", "patient"): None, ("nhs", "gp"): "second", ("new", "x"): "a"}
    assert put_rules(store(spark), batch).count() == 3  # one document per key without an order too
    twice = documents_from_dicts(spark, [{"source": "nhs", "entity": "gp", "single_column_validation_rules": V},
                                         {"source": "nhs", "entity": "gp"}])
    twice = twice.withColumn("version", F.when(F.col("single_column_validation_rules").isNull(), 1).otherwise(2))
    out = [r for r in update_rules(store(spark), twice, order_col="version").collect() if r.entity == "gp"]
    assert len(out) == 1 and out[0].single_column_validation_rules["patient_id"][0].rule == "patient_id is not null"


def test_single_document_calls(spark, survey):
    from qualia.operators.rulestore import get_rule_document, put_rule, update_rule
    from qualia.operators.validate import rule_metrics
    from qualia.sources.rules import rules_of

    s = put_rule(store(spark), "nhs", "patient", ["patient_id", "age"], ["country"], ["cde", "kde"],
                 single_column_validation_rules={"country": [{"rule_name": "country_known", "rule": "country is not null",
                                                              "is_active": 1, "slo": "gt(90)"}]})
    s = update_rule(s, "nhs", "patient", single_column_validation_rules=V)
    doc = get_rule_document(s, "nhs", "patient")
    assert doc["rules_run_on"] == ["cde", "kde"] and doc["kde"] == ["country"]
    rules = rules_of(spark, [doc])
    assert [r["rule_name"] for r in rules] == ["patient_id_isnull"]
    m = rule_metrics(survey, rules).first()
    assert (m.success_count, m.failure_count) == (8, 1)
    assert get_rule_document(s, "nhs", "missing") is None
