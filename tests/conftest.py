import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from qualia.session import local_session  # noqa: E402

SF_DIR = os.environ.get("QUALIA_TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    return local_session(8, shuffle_partitions=8, app="qualia-tests")


# The survey sample behind the recorded goldens
# (9 rows; one patient id missing; timestamps in mixed formats).
SURVEY_ROWS = [
    (11, 10901, "2014-08-27 11:29", 37, "Female", "United States", "IL", "Yes"),
    (10, None, "2014-08-27 11:29:37", 44, "M", "United States", "IN", "No"),
    (10, 19828, "2014-08-27 11:29:44", 32, "Male", "Canada", "NA", "Yes"),
    (10, 10902, "2014-08-27 11:29:46", 31, "Male", "United Kingdom", "NA", "Yes"),
    (10, 10903, "27-08-2017 11:30:22", 31, "Male", "United States", "TX", "Yes"),
    (10, 10904, "2014-08-27 11:31:22", 33, "Male", "United States", "TN", "Yes"),
    (10, 10905, "2014-08-27 11:31:50", 35, "Female", "United States", "MI", "Yes"),
    (10, 10906, "2014-08-27 11:32:05", 39, "M", "Canada", "NA", "Yes"),
    (10, 10907, "2014-08-27 11:32:39", 42, "Female", "United States", "IL", "Yes"),
]
SURVEY_SCHEMA = (
    "GP2_CHI int, patient_id int, Timestamp string, Age int, Gender string, country string, state string, "
    "tech_company string"
)


@pytest.fixture(scope="session")
def survey(spark):
    return spark.createDataFrame(SURVEY_ROWS, SURVEY_SCHEMA)


@pytest.fixture(scope="session")
def recorded(spark):
    """The older sample behind the recorded library output: ids {10901, 10902, 10903,
    19828, 10907 x4, null}; six of nine countries in (United States, United Kingdom)."""
    ids = [10901, None, 19828, 10902, 10903, 10907, 10907, 10907, 10907]
    countries = ["United States", "United States", "Canada", "United Kingdom", "United States", "Canada",
                 "United States", "Canada", "United States"]
    gp2 = [11] + [10] * 8
    return spark.createDataFrame(list(zip(gp2, ids, countries)), "GP2_CHI int, patient_id int, country string")


@pytest.fixture(scope="session")
def accounts(spark):
    src = spark.createDataFrame(
        [
            (123, 5881177, "ABC LTD", dt.date(2006, 1, 1), "UK"),
            (124, 9783784, "XYZ PLC", dt.date(2015, 9, 18), "UK"),
            (125, 4746837, None, dt.date(2003, 4, 28), "UK"),
            (126, 4746838, "PKK PLC", None, "UK"),
            (127, 4746839, "TRS PLC", dt.date(2003, 4, 28), None),
        ],
        "sse_account_id int, business_regn_no int, business_name string, business_regn_dt date, "
        "business_regn_country string",
    )
    ext = spark.createDataFrame(
        [
            (5881177, "ABC LTD", dt.date(2006, 1, 1), "UK", dt.date(2020, 1, 31)),
            (9783784, "XYZ PLC", dt.date(2015, 9, 18), "UK", dt.date(2020, 1, 31)),
            (4746837, "BBD PLC", dt.date(2003, 4, 28), "UK", dt.date(2020, 1, 31)),
            (4746838, "PKK PLC", dt.date(2019, 5, 12), "UK", dt.date(2020, 1, 31)),
            (4746839, "TRS PLC", dt.date(2003, 4, 28), "UK", dt.date(2020, 1, 31)),
        ],
        "company_no int, business_name string, registration_dt date, registered_country string, publish_date date",
    )
    return src, ext
