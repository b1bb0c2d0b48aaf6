"""Published rule versions: snapshots, conflicts, reading as of a version."""

import pytest
from pyspark.sql import functions as F

from qualia.operators import rulestore
from qualia.operators.rule_versions import RuleConflict, RuleVersions
from qualia.sources.rules import documents_from_dicts


def doc(entity, key, source="shop"):
    return {"source": source, "entity": entity, "cde": [key], "kde": [], "rules_run_on": ["cde"], "primary_key": key}


@pytest.fixture
def store(spark, tmp_path):
    return RuleVersions(spark, str(tmp_path / "rules"))


def keys(df):
    return {(r.source, r.entity): r.primary_key for r in df.collect()}


def test_versions_are_read_as_they_were(spark, store):
    assert store.latest() == 0 and store.read().count() == 0 and store.versions() == []
    assert store.put(documents_from_dicts(spark, [doc("basket", "b1"), doc("order", "o1")]), note="first") == 1
    assert store.put(documents_from_dicts(spark, [doc("order", "o2"), doc("till", "t1", "store")])) == 2
    assert store.versions() == [1, 2] and store.note(1) == "first"
    assert keys(store.read(1)) == {("shop", "basket"): "b1", ("shop", "order"): "o1"}
    assert keys(store.read()) == {("shop", "basket"): "b1", ("shop", "order"): "o2", ("store", "till"): "t1"}
    assert keys(store.get("shop", "order", version=1)) == {("shop", "order"): "o1"}
    assert store.rollback(1) == 3 and keys(store.read()) == keys(store.read(1))
    with pytest.raises(KeyError, match="no version 9"):
        store.read(9)
    # another session's view of the same folder
    assert RuleVersions(spark, store.path).latest() == 3


def test_of_two_changes_of_one_version_one_is_refused(spark, store):
    store.put(documents_from_dicts(spark, [doc("basket", "b1")]))
    mine, theirs = RuleVersions(spark, store.path), RuleVersions(spark, store.path)
    theirs.put(documents_from_dicts(spark, [doc("basket", "theirs")]), base=1)
    with pytest.raises(RuleConflict):
        mine.put(documents_from_dicts(spark, [doc("basket", "mine")]), base=1)
    assert keys(store.read()) == {("shop", "basket"): "theirs"} and store.versions() == [1, 2]


def test_a_writer_that_loses_the_race_to_the_commit_is_refused(spark, store, monkeypatch):
    store.put(documents_from_dicts(spark, [doc("basket", "b1")]))
    slow = RuleVersions(spark, store.path)
    monkeypatch.setattr(slow, "latest", lambda: 1)  # it looked before the other one published
    store.put(documents_from_dicts(spark, [doc("basket", "fast")]))
    with pytest.raises(RuleConflict, match="another writer"):
        slow.put(documents_from_dicts(spark, [doc("basket", "slow")]), base=1)
    assert keys(store.read()) == {("shop", "basket"): "fast"}


def test_a_lookup_reads_one_source(spark, store):
    store.put(documents_from_dicts(spark, [doc(f"e{i}", "k", f"s{i}") for i in range(4)]))
    plan = store.get("s2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan
    assert keys(store.get("s2")) == {("s2", "e2"): "k"}


def test_documents_are_dealt_out_in_tasks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(rulestore, "DOCS_A_TASK", 10)
    old = documents_from_dicts(spark, [doc(f"e{i}", "old") for i in range(60)])
    new = spark.range(40).selectExpr("'shop' AS source", "concat('e', id + 40) AS entity", "'new' AS primary_key").coalesce(1)
    for change in (rulestore.put_rules, rulestore.update_rules):
        out = change(old, new)
        assert out.count() == 80 and out.where("primary_key = 'old'").count() == (40 if change is rulestore.put_rules else 60)
        plan = out._jdf.queryExecution().executedPlan().toString()
        dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert dealt and all(", 11), REPARTITION_BY_NUM" in line for line in dealt)  # (60 + 40) documents, and no other shuffle
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 30
