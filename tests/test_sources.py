from qualia.operators.basic import count_by
from qualia.sources.files import read_csv

CSV = """"patient_id","Age","Country","state","Gender","comments"
10901,37,"United States","IL","Female",NA
,44,"United States","IN","M",""
19828,32,"Canada",NA,"Male",NA
10902,31,"United Kingdom",NA,"Male",NA
10903,31,"United States","TX","Male",NA
10904,33,"United States","TN","Male",NA
10905,35,"United States","MI","Female",NA
10906,39,"Canada",NA,"M",NA
10907,42,"United States","IL","Female",NA
"""


def test_csv_inferred_schema_and_country_counts(spark, tmp_path):
    p = tmp_path / "survey.csv"
    p.write_text(CSV)
    df = read_csv(spark, str(p))
    assert df.count() == 9
    types = dict(df.dtypes)
    assert types["patient_id"] == "int" and types["Age"] == "int" and types["comments"] == "string"
    rows = df.collect()
    assert rows[1].patient_id is None and rows[0].comments == "NA" and rows[1].comments is None
    counts = {r["Country"]: r["count"] for r in count_by(df, "Country", where="Age < 40").collect()}
    assert counts == {"United States": 4, "Canada": 2, "United Kingdom": 1}


def test_csv_explicit_schema(spark, tmp_path):
    p = tmp_path / "survey.csv"
    p.write_text(CSV)
    df = read_csv(spark, str(p), schema="patient_id long, Age int, Country string, state string, Gender string, comments string")
    assert dict(df.dtypes)["patient_id"] == "bigint"
