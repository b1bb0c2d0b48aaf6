"""Results do not depend on how statistics are packed into codegen-sized blocks."""

from qualia.operators.metrics import Completeness, Compliance, Mean, MaxLength, Size, Uniqueness, run_metrics
from qualia.operators.profile import column_profiles, profile
from qualia.operators.validate import rule_metrics

RULES = [
    {"element": "Age", "rule": "Age < 40", "rule_name": "young", "slo": "gt(50)"},
    {"element": "country", "rule": "country = 'Canada'", "rule_name": "ca", "slo": "lt(50)"},
    {"element": "patient_id", "rule": "patient_id > 10903", "rule_name": "late", "slo": "ge(10)"},
    {"element": "patient_id", "rule": "uniqueness", "rule_type": "aggregate", "rule_name": "u"},
]
METRICS = [Size(), Completeness("patient_id"), Mean("Age"), MaxLength("country"), Uniqueness("country"),
           Compliance("us", "country = 'United States'")]


def _all(survey):
    return (
        sorted(tuple(r) for r in profile(survey).collect()),
        sorted(tuple(r) for r in profile(survey, frequencies_mode="none").collect()),
        sorted((r.column_name, r.completeness, r.approx_distinct, r.mean, r.sum) for r in column_profiles(survey).collect()),
        sorted(tuple(r) for r in run_metrics(survey, METRICS).collect()),
        sorted(tuple(r) for r in rule_metrics(survey, RULES).collect()),
    )


def test_block_packing_does_not_change_results(spark, survey):
    wide = _all(survey)
    old = spark.conf.get("spark.sql.codegen.maxFields")
    try:
        spark.conf.set("spark.sql.codegen.maxFields", "20")  # forces many small blocks
        narrow = _all(survey)
    finally:
        spark.conf.set("spark.sql.codegen.maxFields", old)
    assert wide == narrow
