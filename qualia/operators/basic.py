"""Small relational operators of the survey scripts (F2, A2/Q6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from qualia.functions.predicates import qcol, resolve_name


def count_by(df: DataFrame, by: str | Sequence[str], where: str | None = None,
             columns: Sequence[str] | None = None) -> DataFrame:
    """Q6: optional SQL-text filter, projection, then row count per group (null is a group).

    Output keeps the requested spelling of the group columns, plus ``count``.
    """
    keys = [by] if isinstance(by, str) else list(by)
    if where:
        df = df.filter(where)
    if columns:
        df = df.select(*[qcol(resolve_name(df, c)) for c in columns])
    return df.groupBy(*[qcol(resolve_name(df, k)).alias(k) for k in keys]).count()
