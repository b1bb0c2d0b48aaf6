import pytest
from pyspark.sql import functions as F

from qualia.operators.reconcile import RECONCILE_COLUMNS, differences, reconcile, reconcile_from_mapping

# The mapping document of the recorded reconciliation (15 rows).
MAPPING = {
    "src": "sse",
    "entity": "sse_account",
    "external_entity": "external_ref",
    "source_primary_key": "sse_account_id",
    "primary_key_mapping": "business_regn_no=company_no",
    "src_ext_mapping": [
        "business_name=business_name",
        "business_regn_dt=registration_dt",
        "business_regn_country=registered_country",
    ],
}


def test_reconcile_goldens(accounts):
    src, ext = accounts
    out = reconcile_from_mapping(src, ext, MAPPING, run_ts="2024-03-05 10:00:00")
    assert out.columns == RECONCILE_COLUMNS
    rows = out.collect()
    assert len(rows) == 15
    diff = sorted((r.primary_key_value, r.attribute_name, r.current_value, r.expected_value)
                  for r in differences(out).collect())
    assert diff == [
        ("125", "business_name", None, "BBD PLC"),
        ("126", "business_regn_dt", None, "2019-05-12"),
        ("127", "business_regn_country", None, "UK"),
    ]
    assert {(r.year, r.month, r.day) for r in rows} == {(2024, 3, 5)}
    assert {str(r.external_data_publish_date) for r in rows} == {"2020-01-31"}
    assert {r.primary_key for r in rows} == {"sse_account_id"}


def test_unmatched_and_null_keys(spark):
    src = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, None, "c"), (4, 40, "d"), (5, 40, "e")],
                                "id int, k int, v string")
    ext = spark.createDataFrame([(10, "a"), (30, "x"), (None, "n"), (40, "d")], "kk int, w string")
    out = reconcile(src, ext, ("k", "kk"), [("v", "w")], primary_key="id", publish_date=None, run_ts="2024-01-01")
    got = sorted((r.primary_key_value or "", r.current_value or "", r.expected_value or "") for r in out.collect())
    assert got == [("", "", "n"), ("", "", "x"), ("1", "a", "a"), ("2", "b", ""), ("3", "c", ""),
                   ("4", "d", "d"), ("5", "e", "d")]
    left = reconcile(src, ext, "k=kk", ["v=w"], primary_key="id", publish_date=None, how="left")
    assert left.count() == 5


def sides(spark, hot_source, hot_external):
    """Keys 0..1999; key 7 holds a third of either side, as asked; null keys on both sides."""
    src = spark.range(0, 3000).selectExpr(
        "id", f"CASE WHEN id < {1000 if hot_source else 1} THEN 7 WHEN id % 50 = 0 THEN NULL ELSE id END AS k", "CAST(id % 97 AS STRING) AS v")
    ext = spark.range(1500, 4500).selectExpr(
        f"CASE WHEN id < {2500 if hot_external else 1501} THEN 7 WHEN id % 70 = 0 THEN NULL ELSE id END AS kk", "CAST(id % 97 AS STRING) AS w")
    return src, ext


@pytest.mark.parametrize("how", ["full_outer", "left"])
@pytest.mark.parametrize("hot_source,hot_external", [(True, False), (False, True), (True, True), (False, False)])
def test_hot_keys_are_dealt_out(spark, how, hot_source, hot_external):
    src, ext = sides(spark, hot_source, hot_external)
    out = reconcile(src, ext, "k=kk", ["v=w"], primary_key="id", publish_date=None, run_ts="2024-01-01", how=how,
                    heavy_rows=300, salts=8)
    got = out.groupBy("primary_key_value", "current_value", "expected_value").count()
    plain = src.join(ext, src["k"] == ext["kk"], how).select(
        src["id"].cast("string").alias("primary_key_value"), src["v"].alias("current_value"), ext["w"].alias("expected_value"))
    want = plain.groupBy("primary_key_value", "current_value", "expected_value").count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_each_side_is_read_for_its_keys_and_once_more(spark, tmp_path):
    src, ext = sides(spark, True, True)
    src.write.parquet(str(tmp_path / "s"))
    ext.write.parquet(str(tmp_path / "e"))
    out = reconcile(spark.read.parquet(str(tmp_path / "s")), spark.read.parquet(str(tmp_path / "e")), "k=kk", ["v=w"],
                    primary_key="id", publish_date=None)
    plan = out._jdf.queryExecution().optimizedPlan().toString().replace("scalar-subquery", "\n")
    rows = [line for line in plan.splitlines() if "Join FullOuter" in line and "_salt_s" in line]
    assert len(rows) == 1  # the one join of the rows


def test_heavy_keys_spread_over_tasks(spark):
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        for hot_source, hot_external in ((True, False), (False, True)):
            src, ext = sides(spark, hot_source, hot_external)
            out = reconcile(src, ext, "k=kk", ["v=w"], primary_key="id", publish_date=None, heavy_rows=300, salts=32)
            sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
            assert max(sizes) < 0.4 * sum(sizes) and len(sizes) >= 6
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_awkward_names(spark):
    src = spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], "`id.x` int, `key col` int, `v.1` string")
    ext = spark.createDataFrame([(10, "a"), (30, "z")], "`k.k` int, `w w` string")
    out = reconcile(src, ext, ("key col", "k.k"), [("v.1", "w w")], primary_key="id.x", publish_date=None)
    got = sorted((r.primary_key_value or "", r.current_value or "", r.expected_value or "") for r in out.collect())
    assert got == [("", "", "z"), ("1", "a", "a"), ("2", "b", "")]


def plain_pairs(src, ext, on, how="full_outer"):
    return src.join(ext, on, how).select(
        src["id"].cast("string").alias("primary_key_value"), src["v"].alias("current_value"), ext["w"].alias("expected_value"))


def found_pairs(out):
    return out.select("primary_key_value", "current_value", "expected_value")


@pytest.mark.parametrize("how", ["full_outer", "left"])
@pytest.mark.parametrize("key,safe", [(["a=x", "b=y"], False), (["a=x", "b<=>y"], True), ([("a", "x"), ("b", "y", True)], True)])
def test_composite_keys_follow_the_null_rule_of_each_part(spark, how, key, safe):
    # (7, null) is hot on the source side, (7, 'k') on the external side
    src = spark.range(0, 2000).selectExpr(
        "id", "IF(id < 700, 7, IF(id % 40 = 0, NULL, id % 300)) AS a", "IF(id < 700, NULL, IF(id % 3 = 0, 'k', 'l')) AS b", "CAST(id % 97 AS STRING) AS v")
    ext = spark.range(0, 1500).selectExpr(
        "CAST(IF(id < 500, 7, IF(id % 30 = 0, NULL, id % 400)) AS INT) AS x", "IF(id < 490, 'k', IF(id % 2 = 0, NULL, 'l')) AS y",
        "CAST(id % 89 AS STRING) AS w")
    out = reconcile(src, ext, key, ["v=w"], primary_key="id", publish_date=None, run_ts="2024-01-01", how=how, heavy_rows=100, salts=8)
    second = src["b"].eqNullSafe(ext["y"]) if safe else src["b"] == ext["y"]
    want = plain_pairs(src, ext, (src["a"] == ext["x"]) & second, how)
    got = found_pairs(out)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_keys_of_different_types_meet_when_heavy(spark):
    src = spark.range(0, 900).selectExpr("id", "CAST(IF(id < 500, 5, id) AS STRING) AS k", "CAST(id AS STRING) AS v")
    ext = spark.range(0, 600).selectExpr("CAST(IF(id < 3, 5, id) AS INT) AS kk", "CAST(id AS STRING) AS w")
    floats = spark.createDataFrame([(i, -0.0 if i % 2 else 0.0, str(i)) for i in range(300)], "id long, k double, v string")
    zeros = spark.createDataFrame([(0.0, "z"), (-0.0, "y"), (1.0, "n")], "kk float, w string")
    for a, b in ((src, ext), (floats, zeros)):
        out = found_pairs(reconcile(a, b, "k=kk", ["v=w"], primary_key="id", publish_date=None, heavy_rows=50, salts=4))
        want = plain_pairs(a, b, a["k"] == b["kk"])
        assert out.exceptAll(want).count() == 0 and want.exceptAll(out).count() == 0


def test_composite_primary_key_is_shown_whole(spark):
    src = spark.createDataFrame([(1, None, "a"), (2, "p", "b")], "k int, part string, v string")
    ext = spark.createDataFrame([(1, None, "a"), (3, "q", "c")], "kk int, piece string, w string")
    out = reconcile(src, ext, ["k=kk", "part<=>piece"], ["v=w"], publish_date=None)
    got = sorted((r.primary_key, r.primary_key_value or "", r.current_value or "", r.expected_value or "") for r in out.collect())
    assert got == [("k,part", "", "", "c"), ("k,part", '["1",null]', "a", "a"), ("k,part", '["2","p"]', "b", "")]


def test_heavy_keys_are_found_without_shuffling_keys(spark):
    from qualia.operators import reconcile as module

    df = spark.range(0, 50_000).selectExpr("IF(id < 20000, 3, id) AS k")
    found = module._heavy_hashes(df, F.xxhash64("k"), F.col("k").isNotNull(), 1000)
    assert found == [spark.range(1).select(F.xxhash64(F.lit(3).cast("long"))).first()[0]]
    top = F.call_function("approx_top_k", F.xxhash64("k"), F.lit(1000), F.lit(32768))
    plan = df.agg(top)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SinglePartition" in plan


def test_no_key_and_empty_sides(spark):
    src = spark.createDataFrame([], "id int, k int, v string")
    ext = spark.createDataFrame([(1, "x")], "kk int, w string")
    assert [r.expected_value for r in reconcile(src, ext, "k=kk", ["v=w"], publish_date=None).collect()] == ["x"]
    with pytest.raises(ValueError, match="no key"):
        reconcile(src, ext, [], ["v=w"], publish_date=None)
