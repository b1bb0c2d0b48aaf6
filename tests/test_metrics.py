import pytest

from qualia.operators.metrics import (
    ApproxCountDistinct, Completeness, Compliance, CountDistinct, Distinctness, Histogram, MaxLength, Mean,
    MetricError, MinLength, Size, StandardDeviation, Sum, Uniqueness, metric_errors, metrics_from_config, run_metrics,
)


def as_dict(df):
    return {(r.entity, r.instance, r.name): r.value for r in df.collect()}


def test_recorded_metric_definitions(recorded):
    m = as_dict(run_metrics(recorded, [
        Size(), Distinctness("patient_id"), Uniqueness(["patient_id"]),
        Compliance("patient_id_completeness", "patient_id is not null"),
        Compliance("country_validity", "country in ('United States','United Kingdom')"),
        Histogram("patient_id"), Completeness("patient_id", where="country = 'JERSY'"),
    ]))
    assert m[("Dataset", "*", "Size")] == 9.0
    assert m[("Column", "patient_id", "Distinctness")] == 0.625
    assert m[("Column", "patient_id", "Uniqueness")] == 0.5
    assert m[("Column", "patient_id_completeness", "Compliance")] == pytest.approx(8 / 9)
    assert m[("Column", "country_validity", "Compliance")] == pytest.approx(6 / 9)
    assert m[("Column", "patient_id", "Histogram.bins")] == 6.0
    assert m[("Column", "patient_id", "Histogram.abs.10907")] == 4.0
    assert m[("Column", "patient_id", "Histogram.ratio.10907")] == pytest.approx(4 / 9)
    assert m[("Column", "patient_id", "Histogram.abs.NullValue")] == 1.0
    # no row matches the filter: the metric is undefined
    assert m[("Column", "patient_id", "Completeness (where: country = 'JERSY')")] is None


def test_numeric_profile_values(recorded):
    m = as_dict(run_metrics(recorded, [Mean("GP2_CHI"), Sum("GP2_CHI"), StandardDeviation("GP2_CHI")]))
    assert m[("Column", "GP2_CHI", "Mean")] == pytest.approx(10.11111111111111)
    assert m[("Column", "GP2_CHI", "Sum")] == 91.0
    assert m[("Column", "GP2_CHI", "StandardDeviation")] == pytest.approx(0.31426968052735454)


def test_lengths_and_count_distinct(survey):
    m = as_dict(run_metrics(survey, [
        MaxLength("country"), MinLength("country"), CountDistinct("country"), MaxLength("Age"),
        Completeness("no_such_column"), ApproxCountDistinct("country"),
    ], on_error="report"))
    assert m[("Column", "country", "MaxLength")] == len("United Kingdom")
    assert m[("Column", "country", "MinLength")] == len("Canada")
    assert m[("Column", "country", "CountDistinct")] == 3.0
    assert m[("Column", "Age", "MaxLength")] is None  # not a string column
    assert m[("Column", "no_such_column", "Completeness")] is None
    assert m[("Column", "country", "ApproxCountDistinct")] == 3.0


def test_multicolumn_uniqueness(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, None), (None, "c")], "k int, v string")
    m = as_dict(run_metrics(df, [Uniqueness(["k", "v"]), Distinctness(["k", "v"])]))
    # rows with all parts null are left out: 4 counted rows, keys (1,a)x2 (1,b) (null,c)
    assert m[("Multicolumn", "k,v", "Uniqueness")] == 0.5
    assert m[("Multicolumn", "k,v", "Distinctness")] == 0.75


def test_metamorphic_self_union(recorded):
    base = as_dict(run_metrics(recorded, [Size(), Distinctness("patient_id"), Uniqueness("patient_id")]))
    doubled = as_dict(run_metrics(recorded.unionAll(recorded),
                                  [Size(), Distinctness("patient_id"), Uniqueness("patient_id")]))
    assert doubled[("Dataset", "*", "Size")] == 2 * base[("Dataset", "*", "Size")]
    assert doubled[("Column", "patient_id", "Distinctness")] == base[("Column", "patient_id", "Distinctness")] / 2
    assert doubled[("Column", "patient_id", "Uniqueness")] == 0.0


def test_metrics_from_config(survey):
    config = [{"rule_name": "completeness", "on_columns": ["patient_id", "Age", "country", "state"]},
              {"rule_name": "distinctness", "on_columns": ["patient_id", "Age", "country", "state"]}]
    m = as_dict(metrics_from_config(survey, config))
    assert m[("Column", "patient_id", "Completeness")] == pytest.approx(8 / 9)
    assert m[("Column", "Age", "Distinctness")] == pytest.approx(8 / 9)
    assert len(m) == 8


def test_many_metrics_split_into_blocks(spark):
    df = spark.range(0, 100).selectExpr(*[f"CASE WHEN id % {k + 2} = 0 THEN NULL ELSE id END AS c{k}" for k in range(40)])
    analyzers = [Completeness(f"c{k}") for k in range(40)] + [Mean(f"c{k}") for k in range(40)]
    analyzers += [ApproxCountDistinct("c0"), Size()]
    m = as_dict(run_metrics(df, analyzers))
    for k in range(40):
        nonnull = [i for i in range(100) if i % (k + 2) != 0]
        assert m[("Column", f"c{k}", "Completeness")] == len(nonnull) / 100
        assert m[("Column", f"c{k}", "Mean")] == pytest.approx(sum(nonnull) / len(nonnull))
    assert m[("Dataset", "*", "Size")] == 100.0
    assert abs(m[("Column", "c0", "ApproxCountDistinct")] - 50) <= 5


def test_failed_metrics_are_reported(survey):
    wanted = [Size(), Compliance("x", "zzz > 0"), Completeness("Age", where="nope = 1"), Uniqueness("Age", where="nope = 1"),
              Uniqueness("Age"), Compliance("sum", "Age + 1"), Uniqueness("zz"), Mean("Age", where="Age > 1000")]
    with pytest.raises(MetricError, match="zzz"):
        run_metrics(survey, wanted)
    rows = {(r.instance, r.name): r for r in run_metrics(survey, wanted, on_error="report").collect()}
    assert len(rows) == len(wanted)
    failed = {k for k, r in rows.items() if r.error}
    assert failed == {("x", "Compliance"), ("Age", "Completeness (where: nope = 1)"), ("Age", "Uniqueness (where: nope = 1)"),
                      ("sum", "Compliance"), ("zz", "Uniqueness")}
    empty = rows[("Age", "Mean (where: Age > 1000)")]
    assert empty.value is None and empty.error is None  # undefined, not failed
    assert {(r.instance, r.name) for r in metric_errors(survey, wanted).collect()} == failed


def test_undefined_values_keep_their_rows(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "x double")
    (row,) = run_metrics(df, [Mean("x")]).collect()
    assert row.name == "Mean"


def test_compliance_by_name_needs_predicate():
    from qualia.operators.metrics import analyzer_for

    with pytest.raises(ValueError, match="predicate"):
        analyzer_for("compliance", "country")
