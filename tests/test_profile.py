import math

import pytest

from qualia.operators.profile import PROFILE_COLUMNS, column_profiles, histogram_long, profile


def by_col(df, key="column_names"):
    return {r[key]: r for r in df.collect()}


def test_profile_goldens(survey):
    out = profile(survey)
    assert out.columns == PROFILE_COLUMNS
    p = by_col(out)
    age = p["Age"]
    assert (age.num_rows, age.num_null, age["count"], age["min"], age["max"]) == (9, 0, 9, "31", "44")
    assert age.mean == 36.0 and age.stddev == pytest.approx(math.sqrt(23.25))
    assert (age.num_distinct, age.most_freq_value, age.most_freq_value_count) == (8, "31", 2)
    pid = p["patient_id"]
    assert (pid.num_null, pid.num_distinct, pid.most_freq_value_count, pid.least_freq_value_count) == (1, 9, 1, 1)
    assert pid.most_freq_value is None  # ties: null first, then smallest text
    assert p["country"].most_freq_value == "United States" and p["country"].most_freq_value_count == 6
    assert p["state"].num_blank == 0 and p["Age"].num_spaces == 0


def test_profile_blanks_spaces_nan(spark):
    df = spark.createDataFrame([("", 1.0), ("  ", float("nan")), (None, None), ("x", 2.0)], "s string, d double")
    p = by_col(profile(df))
    assert (p["s"].num_null, p["s"].num_spaces, p["s"].num_blank) == (1, 1, 1)
    assert p["d"].num_null == 2


def test_profile_empty_table(spark):
    df = spark.createDataFrame([], "a int, b string")
    p = by_col(profile(df))
    assert p["a"].num_rows == 0 and p["a"].num_distinct == 0 and p["a"].most_freq_value is None


def test_profile_modes(survey):
    none = by_col(profile(survey, ["Age", "country"], frequencies_mode="none"))
    assert none["Age"].num_distinct is None


def test_profile_rejects_complex(spark):
    df = spark.createDataFrame([([1],)], "a array<int>")
    with pytest.raises(TypeError):
        profile(df)


def test_library_profile_matches_recording(survey, recorded):
    lib = by_col(column_profiles(survey, ["tech_company"]), "column_name")["tech_company"]
    assert lib.completeness == 1.0 and lib.approx_distinct == 2
    assert lib.data_type == "String" and lib.is_data_type_inferred is False
    assert lib.type_counts == {"Boolean": 0, "Fractional": 0, "Integral": 0, "Unknown": 0, "String": 9}
    assert [(h.value, h["count"]) for h in lib.histogram] == [("Yes", 8), ("No", 1)]
    gp = by_col(column_profiles(recorded, ["GP2_CHI"]), "column_name")["GP2_CHI"]
    assert gp.data_type == "Integral" and gp.type_counts == {}
    assert (gp.minimum, gp.maximum, gp.sum) == (10.0, 11.0, 91.0)
    assert gp.std_dev == pytest.approx(0.31426968052735454)


def test_type_inference(spark):
    df = spark.createDataFrame([("1", "1.5", "true", "1"), ("-2", ".5", "false", "x"), (None, "3", None, "2")],
                               "i string, f string, b string, s string")
    p = by_col(column_profiles(df), "column_name")
    assert (p["i"].data_type, p["i"].is_data_type_inferred) == ("Integral", True)
    assert p["f"].data_type == "Fractional"
    assert p["b"].data_type == "Boolean" and p["b"].type_counts["Unknown"] == 1
    assert p["s"].data_type == "String"


def test_histograms_keep_every_bin(spark):
    df = spark.range(0, 500).selectExpr("id % 121 AS wide", "CASE WHEN id % 2 = 0 THEN id % 119 END AS narrow")
    bins = {c: sum(1 for _ in rows) for c, rows in
            {c: [r for r in histogram_long(df, ["wide", "narrow"]).collect() if r.column_name == c] for c in ("wide", "narrow")}.items()}
    assert bins == {"wide": 121, "narrow": 120}
    p = by_col(column_profiles(df), "column_name")
    assert (p["wide"].bins, p["wide"].histogram_kept, p["wide"].histogram) == (121, False, None)
    assert (p["narrow"].bins, p["narrow"].histogram_kept, len(p["narrow"].histogram)) == (120, True, 120)
    wide = by_col(column_profiles(df, histogram_threshold=121), "column_name")["wide"]
    assert wide.histogram_kept and sum(h["count"] for h in wide.histogram) == 500
    assert {r.column_name for r in histogram_long(df, ["wide", "narrow"], threshold=120).collect()} == {"narrow"}


def test_library_profile_is_lazy(spark):
    boom = spark.range(5).selectExpr("raise_error('a job ran') AS x", "id")
    assert "bins" in column_profiles(boom).columns


def test_all_null_keys_read_as_null(spark):
    from qualia.operators.metrics import Histogram, run_metrics

    df = spark.createDataFrame([(None, None), (None, 1), (2, None)], "a int, b int")
    names = {r.name for r in run_metrics(df, [Histogram(["a", "b"])]).collect()}
    assert "Histogram.abs.NullValue" in names and 'Histogram.abs.{"0":"2","1":null}' in names


def test_percentiles(spark):
    df = spark.range(1, 1001).selectExpr("CAST(id AS DOUBLE) AS x")
    p = column_profiles(df, percentiles=[0.5, 0.9]).first()
    assert p.approx_percentiles == [500.0, 900.0]


def test_negative_zero_reads_as_zero(spark):
    for rows in ([(-0.0,), (0.0,), (2.5,)], [(0.0,), (-0.0,), (2.5,)], [(-0.0,), (-1.0,)]):
        df = spark.createDataFrame(rows, "d double")
        p = profile(df).first()
        want_min = "-1.0" if (-1.0,) in rows else "0.0"
        assert p["min"] == want_min
        assert p["max"] in ("2.5", "0.0") and p["max"] != "-0.0"
        assert column_profiles(df).first().minimum == float(want_min)


def test_awkward_column_names(spark):
    from qualia.operators.metrics import Completeness, Distinctness, Histogram, Uniqueness, run_metrics

    df = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (None, "y", 3)], "`a.b` int, `n` string, `my col` int")
    p = {r.column_names: r for r in profile(df).collect()}
    assert p["a.b"].num_null == 1 and p["a.b"].num_distinct == 2 and p["n"].most_freq_value == "y"
    m = {(r.instance, r.name): r.value for r in run_metrics(df, [
        Completeness("a.b"), Distinctness("n"), Uniqueness(["a.b", "my col"]), Histogram("n")]).collect()}
    assert m[("a.b", "Completeness")] == 2 / 3 and m[("n", "Distinctness")] == 2 / 3
    assert m[("n", "Histogram.abs.y")] == 2.0
    assert {r.column_name for r in column_profiles(df).collect()} == {"a.b", "n", "my col"}
