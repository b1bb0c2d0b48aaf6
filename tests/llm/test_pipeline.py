"""The registered queries against their SQL, and the pipeline's stages against brute force."""

import os

import duckdb
import pytest
from test_dedup import brute_components

import __spark_entry__ as entry
import corpus_pipeline
from qualia.llm import ordinal_quality, zstd_language
from qualia.llm.oracle import ORACLE
from qualia.llm.queries import QUERIES, grades

SF = os.environ.get("QUALIA_TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for source in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {source} AS SELECT * FROM read_parquet('{SF}/{source}.parquet')")
    found = QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    expected = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(tuple(r) for r in found.select(columns).collect()) == sorted(expected)


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "exact", "near", "pack"]
    outs = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        outs[name] = (before, docs)
        if name != "pack":
            assert docs.columns == columns

    before, after = outs["quality"]
    model = ordinal_quality.fit(before, grades(spark.read.parquet(f"{SF}/labels.parquet")))
    good = {r.doc_id for r in ordinal_quality.score(before, model).where("kept").collect()}
    assert {r.doc_id for r in after.collect()} == good

    before, after = outs["language"]
    said = zstd_language.predict(before, zstd_language.learn_dictionaries(before)).where("accepted")
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in said.collect()}
    assert after.count() >= 0.98 * before.count()

    before, after = outs["exact"]
    last = {}
    for r in before.collect():
        last[r.text] = max(last.get(r.text, -1), r.doc_id)
    assert sorted(r.doc_id for r in after.collect()) == sorted(last.values())

    before, after = outs["near"]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    firsts = {c for i, n, c in brute_components(rows) if n} | {i for i, n, _ in brute_components(rows) if not n}
    assert {r.doc_id for r in after.collect()} == firsts

    before, after = outs["pack"]
    assert {r.doc_id for r in after.select("doc_id").distinct().collect()} == {r.doc_id for r in before.collect()}
    assert after.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 2048").count() == 0


def test_run_returns_the_last_stage(spark):
    assert set(corpus_pipeline.run(spark, "/root/testdata/sf0.001").columns) >= {"doc_id", "sequence_id", "offset", "length", "ids"}
