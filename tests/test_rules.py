"""Rule documents, row results and rule metrics on a library's loans."""

import json

import pytest

from qualia.functions.predicates import RuleError, parse_slo, pct_half_up
from qualia.operators.validate import as_rules, row_results, rule_error_table, rule_errors, rule_metrics
from qualia.sources.rules import (
    documents_from_dicts,
    malformed_documents,
    read_rule_documents,
    rules_of,
    rules_table,
    select_rules,
)

# loan, member, branch, days out, fine: one member missing, one branch unknown, one fine missing
LOANS = [
    (1, 70, "North", 3, 0.0), (2, 71, "South", 40, 4.5), (3, None, "north", 12, 0.0), (4, 70, "East", 0, 0.0),
    (5, 72, "South", 90, None), (6, 73, "North", 21, 1.0), (7, 71, "South", -1, 0.0), (8, 74, "East", 7, 0.0),
]
DOC = {
    "source": "library",
    "entity": "loans",
    "cde": ["Member", "days_out"],
    "kde": ["branch"],
    "rules_run_on": ["cde", "kde"],
    "primary_key": "loan",
    "single_column_validation_rules": {
        "member": [
            {"rule_name": "lent_to_someone", "rule": "member is not null", "dimension": "completeness", "slo": "ge(80)"},
            {"rule_name": "many_members", "rule": "distinctness", "rule_type": "aggregate", "slo": "ge(90)"},
        ],
        "days_out": [
            {"rule_name": "not_returned_early", "rule": "days_out >= 0", "is_active": 1, "slo": "eq(100)"},
            {"rule_name": "paused", "rule": "days_out > 1000", "is_active": 0},
        ],
        "Branch": [{"rule_name": "known_branch", "rule": "branch in ('North', 'South', 'East')", "is_active": 1, "slo": "gt(85)"}],
        "fine": [{"rule_name": "nobody_lists_fine", "rule": "fine >= 0", "is_active": 1}],
    },
    "dataset_level_validation_rules": [
        {"rule_name": "busy_day", "rule": "hasSize", "is_active": 1, "service_level_objective": "lt(5)"}
    ],
}


@pytest.fixture(scope="module")
def loans(spark):
    return spark.createDataFrame(LOANS, "loan int, member int, branch string, days_out int, fine double")


@pytest.fixture(scope="module")
def rules(spark):
    return select_rules(rules_table(documents_from_dicts(spark, [DOC])))


def test_only_listed_and_active_rules_run(spark, rules):
    assert {r.rule_name for r in rules.collect()} == {"lent_to_someone", "many_members", "not_returned_early", "known_branch", "busy_day"}
    only_kde = rules_of(spark, [DOC | {"rules_run_on": ["kde"]}])
    assert {r["rule_name"] for r in only_kde} == {"known_branch", "busy_day"}
    assert {r["rule_type"] for r in only_kde if r["level"] == "column"} == {"non_aggregate"}  # the default


def test_metrics(loans, rules):
    got = {r.rule_name: (r.success_count, r.failure_count, r["count"], r.pass_percentage, r.constraint_status)
           for r in rule_metrics(loans, rules).collect()}
    assert got == {
        "lent_to_someone": (7, 1, 8, 87.5, True),
        "many_members": (5, 2, 7, 71.43, False),
        "not_returned_early": (7, 1, 8, 87.5, False),
        "known_branch": (7, 1, 8, 87.5, True),
        "busy_day": (8, 0, 8, None, False),
    }
    again = {r.rule_name: r.success_count for r in rule_metrics(loans.repartition(3), rules).collect()}
    assert again == {k: v[0] for k, v in got.items()}


def test_row_results(loans, rules):
    out = row_results(loans, rules, pass_through=["loan"], run_ts="2031-07-09 08:00:00")
    rows = out.collect()
    assert len(rows) == 3 * len(LOANS) and out.columns[0] == "loan" and rows[0].run_date.month == 7
    failed = row_results(loans, rules, pass_through=["loan"], only_failures=True).collect()
    assert sorted((r.loan, r.rule_name, r.value) for r in failed) == [
        (3, "known_branch", "north"), (3, "lent_to_someone", None), (7, "not_returned_early", "-1")]


def test_null_verdicts_count_in_neither(loans):
    r = rule_metrics(loans, [{"element": "fine", "rule": "fine = 0", "rule_name": "free", "slo": "le(62.5)"}]).first()
    assert (r.success_count, r.failure_count, r["count"], r.pass_percentage, r.constraint_status) == (5, 2, 8, 62.5, True)


def test_several_aggregate_rules_need_no_expand(loans):
    made = [{"element": c, "rule": k, "rule_name": f"{k}-{c}", "rule_type": "aggregate"}
            for c in ("member", "branch", "fine") for k in ("uniqueness", "distinctness", "completeness")]
    out = rule_metrics(loans, made)
    got = {r.rule_name: (r.success_count, r["count"]) for r in out.collect()}
    assert got["uniqueness-member"] == (5, 8) and got["distinctness-member"] == (5, 7) and got["completeness-fine"] == (7, 8)
    assert got["uniqueness-branch"] == (4, 8) and got["distinctness-fine"] == (3, 7)
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    empty = {r.rule_name: (r.success_count, r["count"]) for r in rule_metrics(loans.where("false"), made).collect()}
    assert set(empty.values()) == {(0, 0)}


def test_rules_of_other_entities_and_out_of_scope_do_not_run(spark, loans):
    table = rules_table(documents_from_dicts(spark, [DOC, DOC | {"entity": "returns"}]))
    with pytest.raises(ValueError, match="several entities"):
        rule_metrics(loans, table)
    names = {r.rule_name for r in as_rules(table, "library", "loans")}
    assert "nobody_lists_fine" not in names and "known_branch" in names
    assert len(names) == len(as_rules(table, "library", "returns"))


BAD = [
    ("misspelt", "days_owt > 3", None), ("half_a_rule", "days_out +", None), ("a_number", "days_out * 2", None),
    ("an_aggregate", "max(days_out) > 3", None), ("odd_objective", "days_out > 3", "around(9)"), ("empty", " ", None),
]


def test_bad_rules_are_named(loans):
    good = {"element": "days_out", "rule": "days_out < 30 -- a month", "rule_name": "short"}
    made = [good, *({"element": "days_out", "rule": r, "rule_name": n, "slo": s} for n, r, s in BAD),
            {"element": "shelf", "rule": "1 = 1", "rule_name": "no_such_element"},
            {"element": "branch", "rule": "entropy", "rule_type": "aggregate", "rule_name": "unknown_kind"}]
    names = sorted([n for n, _, _ in BAD] + ["no_such_element", "unknown_kind"])
    assert sorted(e.rule_name for e in rule_errors(loans, made)) == names
    assert sorted(r.rule_name for r in rule_error_table(loans, made).collect()) == names
    assert [(r.rule_name, r.success_count) for r in rule_metrics(loans, made, on_error="skip").collect()] == [("short", 6)]
    assert row_results(loans, made, on_error="skip").count() == len(LOANS)
    for name, rule, slo in BAD[:4]:
        with pytest.raises(RuleError, match=name):
            rule_metrics(loans, [good, {"element": "days_out", "rule": rule, "rule_name": name, "slo": slo}])


def test_percentages_round_half_up(spark):
    df = spark.createDataFrame([(1, 16), (1, 7), (3, 800), (0, 0), (5, 5)], "s long, n long")
    assert [r[0] for r in df.select(pct_half_up("s", "n")).collect()] == [6.25, 14.29, 0.38, None, 100.0]


def test_objectives():
    assert parse_slo("le(7)") == ("le", 7.0) and parse_slo("  eq( 0.25 )") == ("eq", 0.25) and parse_slo(None) is None
    with pytest.raises(ValueError):
        parse_slo("within(1, 2)")


def test_more_rules_than_one_aggregation_holds(spark):
    df = spark.range(300).selectExpr("id", "nullif(id % 13, 5) AS r")
    made = [{"element": "r", "rule": f"r > {k}", "rule_name": f"over_{k}"} for k in range(13)] * 1
    made += [{"element": "id", "rule": f"id % {k} = 0", "rule_name": f"by_{k}"} for k in range(2, 70)]
    got = {r.rule_name: (r.success_count, r.failure_count) for r in rule_metrics(df, made).collect()}
    kept = [i % 13 for i in range(300) if i % 13 != 5]
    for k in range(13):
        assert got[f"over_{k}"] == (sum(v > k for v in kept), sum(v <= k for v in kept))
    for k in range(2, 70):
        assert got[f"by_{k}"] == (len(range(0, 300, k)), 300 - len(range(0, 300, k)))


GROUPED = {
    "source": "library",
    "entities": [
        {
            "entity": "loans", "cde": ["member", "days_out"], "kde": ["branch"], "run_rules_on": ["cde"],
            "profiler_rules": {
                "cde": [{"rule_name": "completeness", "on_columns": ["member", "branch"]}, {"rule_name": "uniqueness"}],
                "kde": [{"rule_name": "distinctness", "on_columns": ["member"]}],
            },
            "validation_rules": {
                "cde": [{"rule_name": "sane", "rule": "Days_Out between 0 and 60"}, {"rule_name": "always", "rule": "1 = 1"},
                        {"rule_name": "branches", "rule": "branch in ('North','South')"}],
                "kde": [{"rule_name": "not_on", "rule": "branch = 'East'"}],
            },
        },
        {"entity": "shelves", "kde": ["shelf"], "rules_run_on": ["kde"],
         "single_column_validation_rules": {"shelf": [{"rule_name": "numbered", "rule": "shelf > 0"}]}},
    ],
}


def test_rules_listed_per_group(spark, tmp_path, loans):
    (tmp_path / "rules.json").write_text(json.dumps(GROUPED, indent=1))
    rules = rules_table(read_rule_documents(spark, str(tmp_path / "rules.json")))
    chosen = {(r.entity, r.kind, r.element, r.rule_name) for r in select_rules(rules, kind=None).collect()}
    assert chosen == {
        ("loans", "profile", "member", "member_completeness"),  # branch is not on; the kde group does not run
        ("loans", "validation", "days_out", "sane"), ("loans", "validation", "member", "always"),
        ("shelves", "validation", "shelf", "numbered"),
    }
    every = {(r.element, r.rule_name, r.in_scope) for r in rules.where("entity = 'loans' AND kind = 'validation'").collect()}
    assert ("branch", "branches", False) in every and not any(n == "not_on" for _, n, _ in every)
    got = {r.rule_name: r.success_count for r in rule_metrics(loans, select_rules(rules).where("entity = 'loans'")).collect()}
    assert got == {"sane": 6, "always": 8}


def test_files_of_documents(spark, tmp_path):
    (tmp_path / "many.jsonl").write_text("\n".join(json.dumps(DOC | {"entity": f"e{i}"}) for i in range(3)))
    assert read_rule_documents(spark, str(tmp_path / "many.jsonl"), multi_line=False).count() == 3
    (tmp_path / "broken.json").write_text(json.dumps(DOC)[:-1] + ",}")
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE"):
        read_rule_documents(spark, str(tmp_path / "broken.json")).collect()
    assert malformed_documents(spark, str(tmp_path / "broken.json")).count() == 1


def test_unnamed_dimensions_get_one_name(spark):
    doc = DOC | {"single_column_profiler_rules": {"member": [{"dimension": None, "dimension_rule": "member > 0"}]}}
    assert [r["rule_name"] for r in rules_of(spark, [doc], kind="profile")] == ["member"]
