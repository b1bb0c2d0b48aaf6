"""The driver's correctness gate, run locally: every registered query against its DuckDB oracle."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry_mod  # noqa: E402
from compare import rows_of  # noqa: E402
from conftest import SF_DIR  # noqa: E402
from qualia.plans import QUERIES as CORE  # noqa: E402
from qualia.plans.common import TABLES  # noqa: E402

QUERIES = {name: fn for name, fn in entry_mod.queries().items() if name in CORE}
ORACLE = {name: sql for name, sql in entry_mod.oracle_sql().items() if name in CORE}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_listed():
    rows_only = set(QUERIES) - set(ORACLE)
    assert not rows_only, rows_only
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_DIR)
    s_rows, s_cols = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
    if name not in ORACLE:
        assert len(s_rows) > 0
        return
    res = duck.execute(ORACLE[name])
    d_rows, d_cols = rows_of([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
