"""Stored results, packed row results, checked CSV reads, rules of many entities, evaluated suggestions."""

import pytest
from pyspark.sql import functions as F

from qualia.functions.predicates import RuleError
from qualia.operators.by_entity import rule_metrics_by_entity
from qualia.operators.metrics import Size, run_metrics
from qualia.operators.packed import packed_row_results
from qualia.operators.results import history, read_results, write_results
from qualia.operators.suggest import evaluate_suggestions
from qualia.operators.validate import row_results, rule_metrics
from qualia.sources.files import good_rows, quarantine, read_csv_checked, refused_rows

RULES = [
    {"element": "age", "rule": "age > 10", "rule_name": "old", "slo": "ge(50)"},
    {"element": "name", "rule": "length(name) < 3 -- short", "rule_name": "short"},
    {"element": "AGE", "rule": "age is not null", "rule_name": "aged"},
]
PEOPLE = [(1, "a", 5, "x"), (2, "bbb", 20, "x"), (3, None, None, "y"), (4, "", 11, "y"), (5, "cc", None, None)]


@pytest.fixture
def people(spark):
    return spark.createDataFrame(PEOPLE, "id int, name string, age int, team string")


def bag(df):
    return sorted(map(str, df.collect()))


# --- stored results


def test_a_run_written_again_replaces_only_itself(spark, tmp_path):
    path = str(tmp_path / "results")
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "name string, value double")
    write_results(df, path, "007")
    write_results(df.withColumn("value", F.col("value") * 3), path, "008/x y")
    write_results(df.where("name = 'a'").withColumns({"value": F.col("value") * 5, "note": F.lit("again")}), path, "008/x y")
    got = {(r.run_id, r.name, r.value, r.note) for r in read_results(spark, path).collect()}
    assert got == {("007", "a", 1.0, None), ("007", "b", 2.0, None), ("008/x y", "a", 5.0, "again")}
    assert read_results(spark, path, ["007"]).count() == 2
    told = {(r.run_id, r.name): (r.previous, r.change, r.run_number) for r in history(read_results(spark, path), ["name"]).collect()}
    assert told == {("007", "a"): (None, None, 1), ("007", "b"): (None, None, 1), ("008/x y", "a"): (1.0, 4.0, 2)}
    write_results(df.where("name = 'none'"), path, "007")  # the run has no rows any more
    assert {r.run_id for r in read_results(spark, path).collect()} == {"008/x y"}


def test_results_that_do_not_fit_are_refused(spark, tmp_path):
    path = str(tmp_path / "results")
    df = spark.createDataFrame([("a", 1.0)], "name string, value double")
    write_results(df, path, "1")
    with pytest.raises(ValueError, match="change their type: value"):
        write_results(df.withColumn("value", F.lit("text")), path, "2")
    with pytest.raises(ValueError, match="run_id already"):
        write_results(df.withColumn("run_id", F.lit("x")), path, "2")
    with pytest.raises(ValueError, match="needs an id"):
        write_results(df, path, "")
    with pytest.raises(ValueError, match="no results"):
        read_results(spark, str(tmp_path / "elsewhere"))
    assert read_results(spark, path).count() == 1


# --- packed row results


def test_unpacked_bitmaps_are_the_row_results(people, tmp_path, spark):
    packed = packed_row_results(people, RULES, ["id"])
    assert packed.rows.count() == people.count()
    plain = row_results(people, RULES, ["id"], run_ts="2024-01-01")
    assert bag(packed.unpack(run_ts="2024-01-01")) == bag(plain)
    path = str(tmp_path / "packed")
    packed.rows.write.parquet(path)
    back = spark.read.parquet(path)
    assert bag(packed.unpack(back, ["aged"], run_ts="2024-01-01")) == bag(plain.where("rule_name = 'aged'"))
    assert {r.id for r in packed.failures(back).collect()} == {r.id for r in plain.where("result = false").collect()}
    want = {r.rule_name: r.failure_count for r in rule_metrics(people, RULES).collect()}
    assert {r.rule_name: r.failure_count for r in packed.false_counts(back).collect()} == want
    with pytest.raises(ValueError, match="clash"):
        packed_row_results(people.withColumnRenamed("id", "passed"), RULES, ["passed"])


def test_more_rules_than_a_word_has_bits(spark):
    df = spark.range(0, 40).selectExpr("id", "nullif(id % 5, 4) AS v")
    rules = [{"element": "v", "rule": f"v * {i} % 7 < 4", "rule_name": f"r{i}"} for i in range(130)]
    packed = packed_row_results(df, rules, ["id"])
    assert len(packed.rows.first().passed) == 3
    assert bag(packed.unpack(run_ts="2024-01-01")) == bag(row_results(df, rules, ["id"], run_ts="2024-01-01"))
    wrong = {r.id for r in row_results(df, rules, ["id"]).where("result = false").collect()}
    assert {r.id for r in packed.failures().collect()} == wrong


def test_packing_neither_shuffles_nor_multiplies_rows(people):
    plan = packed_row_results(people, RULES, ["id"]).rows._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


# --- checked CSV reads

LINES = ["id,name,day,score", "1,ann,2024-01-02,1.5", "x,bob,2024-01-02,2", "3,,2024-99-01,nope", "4,dan", "5,eve,2024-01-05,2,extra", " 6 ,fay,,",
         '7,"g,h",2024-01-07,3e2', '8,"two\nlines",2024-01-08,4']
CSV_SCHEMA = "id int, name string, day date, score double"


def test_every_line_is_typed_or_refused_with_reasons(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("\n".join(LINES) + "\n")
    checked = read_csv_checked(spark, str(path), CSV_SCHEMA, multiLine="true")
    good = {(r.id, r.name, str(r.day), r.score) for r in good_rows(checked).collect()}
    assert good == {(1, "ann", "2024-01-02", 1.5), (6, "fay", "None", None), (7, "g,h", "2024-01-07", 300.0), (8, "two\nlines", "2024-01-08", 4.0)}
    refused = {r._record: r._errors for r in refused_rows(checked).collect()}
    assert refused == {
        '{"id":"x","name":"bob","day":"2024-01-02","score":"2"}': ["id: not a int"],
        '{"id":"3","day":"2024-99-01","score":"nope"}': ["day: not a date", "score: not a double"],
        "4,dan": ["malformed"], "5,eve,2024-01-05,2,extra": ["malformed"]}
    kept, put_aside = quarantine(checked, str(tmp_path / "out"))
    assert bag(kept) == bag(good_rows(checked)) and bag(put_aside) == bag(refused_rows(checked))
    assert kept.columns == ["id", "name", "day", "score"]


def test_good_and_refused_rows_take_one_scan(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("\n".join(LINES[:3]) + "\n")
    plan = read_csv_checked(spark, str(path), CSV_SCHEMA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Exchange" not in plan
    with pytest.raises(ValueError, match="clash"):
        read_csv_checked(spark, str(path), "id int, _errors string")


def test_empty_csv(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("id,name,day,score\n")
    checked = read_csv_checked(spark, str(path), CSV_SCHEMA)
    assert good_rows(checked).count() == 0 and refused_rows(checked).count() == 0


# --- rules of many entities

TEAMS = [
    {"entity": "x", "source": "s", "element": "age", "rule": "age > 10", "rule_name": "old", "slo": "ge(50)"},
    {"entity": "x", "source": "s", "element": "name", "rule": "uniqueness", "rule_type": "aggregate", "rule_name": "u", "slo": "eq(100)"},
    {"entity": "y", "source": "s", "element": "age", "rule": "1 / (id - 1) > 0", "rule_name": "fails on team x"},
    {"entity": "y", "source": "s", "element": "age", "rule": "distinctness", "rule_type": "aggregate", "rule_name": "d"},
    {"entity": "y", "source": "s", "element": "name", "rule": "completeness", "rule_type": "aggregate", "rule_name": "c"},
    {"entity": "y", "source": "s", "element": "*", "rule": "hasSize", "level": "dataset", "rule_name": "size", "slo": "gt(1)"},
]


def test_each_entity_has_the_metrics_of_its_own_rows(people):
    found = rule_metrics_by_entity(people, TEAMS, "team")
    alone = None
    for team in ("x", "y"):
        part = rule_metrics(people.where(F.col("team") == team), [r for r in TEAMS if r["entity"] == team])
        alone = part if alone is None else alone.unionByName(part)
    assert found.columns == alone.columns and bag(found) == bag(alone)


def test_entities_share_one_scan(people, spark, tmp_path):
    people.write.parquet(str(tmp_path / "people"))
    df = spark.read.parquet(str(tmp_path / "people"))
    rows = [r for r in TEAMS if r["rule_name"] in ("old", "c", "size", "fails on team x")]
    plan = rule_metrics_by_entity(df, rows, "team")._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("FileScan parquet") == 1
    both = rule_metrics_by_entity(df, TEAMS, "team")._jdf.queryExecution().executedPlan().toString()
    assert both.split("Initial Plan")[0].count("FileScan parquet") == 2


def test_an_entity_without_rows_and_bad_rules(people):
    nobody = [dict(r, entity="z") for r in TEAMS[:2]]
    got = {r.rule_name: (r.success_count, r["count"], r.pass_percentage, r.constraint_status) for r in rule_metrics_by_entity(people, nobody, "team").collect()}
    assert got == {"old": (0, 0, None, None), "u": (0, 0, None, None)}
    with pytest.raises(RuleError, match="no column"):
        rule_metrics_by_entity(people, [dict(TEAMS[0], element="nowhere")], "team")
    with pytest.raises(RuleError):
        rule_metrics_by_entity(people, [dict(TEAMS[0], rule="nowhere > 1")], "team")
    with pytest.raises(ValueError, match="no active rules"):
        rule_metrics_by_entity(people, [dict(TEAMS[0], is_active=0)], "team")


# --- evaluated suggestions


def test_suggestions_are_tested_on_rows_they_did_not_see(spark):
    df = spark.range(0, 1000).selectExpr(
        "id", "IF(id % 4 = 0 AND id > 500, NULL, 'v') AS some", "IF(id % 4 = 0, -1, 1) AS sign", "IF(id % 4 = 0, 'new', 'old') AS kind",
        "CAST(id AS STRING) AS digits")
    found = {(r.column_name, r.constraint): r for r in evaluate_suggestions(df, "id % 4 = 0").collect()}
    assert {r.holdout_rows for r in found.values()} == {250}
    told = {k: (round(r.holdout_value, 4), r.holds) for k, r in found.items()}
    assert told["id", "isUnique"] == (1.0, True) and told["id", "isComplete"] == (1.0, True)
    assert told["some", "isComplete"] == (round(126 / 250, 4), False)
    assert told["sign", "isNonNegative"] == (0.0, False) and told["kind", "isContainedIn"] == (0.0, False)
    assert told["digits", "hasDataType"] == (1.0, True)


def test_the_hash_split_is_repeatable_and_bounded(spark):
    df = spark.range(0, 2000).selectExpr("id", "id % 3 AS v")
    first = evaluate_suggestions(df, 0.25)
    assert bag(first) == bag(evaluate_suggestions(df.repartition(7), 0.25))
    assert 400 < first.first().holdout_rows < 600
    with pytest.raises(ValueError, match="share"):
        evaluate_suggestions(df, 1.5)
    none = evaluate_suggestions(df, "false").collect()
    assert none and all(r.holds is None and r.holdout_rows == 0 for r in none)
