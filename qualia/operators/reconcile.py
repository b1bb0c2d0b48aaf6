"""Reconciliation (Q5): compare a source table with an external reference, attribute by
attribute, after an outer join on a key of one or more parts that have different names on each side.

Output, one row per joined row and mapped attribute: ``primary_key, primary_key_value,
attribute_name, current_value, expected_value, external_data_source,
external_data_publish_date, run_date, year, month, day`` (values as text, because the
attributes mix types).

A key part ``'src=ext'`` matches equal values and never null; ``'src<=>ext'`` takes two nulls for equal.

Plan, shaped for skewed keys (one key value may hold a third of either side):

* one map-side pass per side over the key hashes keeps a frequent-items sketch of fixed size
  (``approx_top_k``): no key is shuffled. Keys whose count in it exceeds ``heavy_rows`` and a
  thousandth of the side are heavy: fewer than 1000 of each side by their number, a list of hashes
  in the plan. An estimate is enough: the list only decides where rows meet, never whether;
* matched and unmatched rows of both sides come from ONE join on (key, salt): rows of a heavy
  key are dealt over the salts, and the other side's rows of that key are repeated for each
  salt. A repeated row that meets nothing at its salt is dropped: its key is on both sides;
* rows with a null in a part that null does not match are dealt over the salts too;
* every attribute is emitted from the same joined row with ``inline``.

``how='full_outer'`` (default) keeps unmatched rows of both sides; ``how='left'`` keeps the
source side only.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualia.functions.predicates import FLOATING_TYPES, field_type, qcol, resolve_name

RECONCILE_COLUMNS = [
    "primary_key",
    "primary_key_value",
    "attribute_name",
    "current_value",
    "expected_value",
    "external_data_source",
    "external_data_publish_date",
    "run_date",
    "year",
    "month",
    "day",
]


def prefix_columns(df: DataFrame, prefix: str, cols: Sequence[str] | None = None) -> DataFrame:
    """every (or the listed) column renamed ``prefix + name``."""
    cols = list(cols) if cols is not None else df.columns
    return df.select([qcol(c).alias(prefix + c) for c in cols])


def _pairs(items) -> list[tuple[str, str]]:
    out = []
    for it in items:
        if isinstance(it, str):
            a, b = it.split("=", 1)
            out.append((a.strip(), b.strip()))
        else:
            out.append((it[0], it[1]))
    return out


def _run_date(run_ts) -> Column:
    if run_ts is None:
        return F.localtimestamp()
    if isinstance(run_ts, _dt.datetime):
        run_ts = run_ts.isoformat(sep=" ")
    return F.lit(str(run_ts)).cast("timestamp_ntz")


def _key_parts(key) -> list[tuple[str, str, bool]]:
    """(source column, external column, whether null matches null) of ``'a=b'``, ``'a<=>b'``, pairs, or a list of them."""
    if isinstance(key, str):
        items = [key]
    elif isinstance(key, tuple) and len(key) == 2 and all(isinstance(k, str) and "=" not in k for k in key):
        items = [key]
    else:
        items = list(key)
    out = []
    for item in items:
        if isinstance(item, str):
            safe = "<=>" in item
            a, b = item.split("<=>" if safe else "=", 1)
            out.append((a.strip(), b.strip(), safe))
        else:
            out.append((item[0], item[1], len(item) > 2 and bool(item[2])))
    if not out:
        raise ValueError("no key")
    return out


def _common_type(a: T.DataType, b: T.DataType, spark) -> T.DataType:
    """The type in which the join compares ``a`` and ``b``."""
    if a == b:
        return a
    return spark.range(0).select(F.coalesce(F.lit(None).cast(a), F.lit(None).cast(b)).alias("k")).schema["k"].dataType


def _hash(columns: Sequence[Column], types: Sequence[T.DataType]) -> Column:
    """The same hash for keys that are equal, on either side."""
    typed = [c.cast(t) for c, t in zip(columns, types)]
    return F.xxhash64(*[F.when(c == 0, F.lit(0.0).cast(t)).otherwise(c) if isinstance(t, FLOATING_TYPES) else c for c, t in zip(typed, types)])


# Sketch entries: counts above 3.5 / HEAVY_ENTRIES of the rows are found, far below the thousandth that is asked for.
_HEAVY_ENTRIES = 32768
_HEAVY_KEYS = 1000


def _heavy_hashes(df: DataFrame, key_hash: Column, matchable: Column, heavy_rows: int) -> list[int]:
    """Hashes of the side's heavy keys (fewer than 1000), from one map-side pass over its keys."""
    top = F.call_function("approx_top_k", F.when(matchable, key_hash), F.lit(_HEAVY_KEYS), F.lit(_HEAVY_ENTRIES))
    one = df.agg(top.alias("top"), F.count_if(matchable).alias("total")).first()
    return [t["item"] for t in one.top or [] if t["item"] is not None and t["count"] > heavy_rows and t["count"] * 1000 > one.total]


def _salted(df: DataFrame, key_hash: Column, matchable: Column, mine: list[int], theirs: list[int], side: str, salts: int) -> DataFrame:
    """Rows with a salt: dealt (heavy on the own side, or a key that matches nothing), repeated for every salt
    (heavy on the other side only, or dealt there), else salt 0. Keys heavy on both sides are dealt on the
    source side."""
    if side == "e":
        mine = sorted(set(mine) - set(theirs))
    dealt = ~matchable | key_hash.isin(mine)
    copied = matchable & key_hash.isin(sorted(set(theirs) - set(mine)))
    own_salt = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    rows = df.select(
        *[qcol(c) for c in df.columns], F.lit(True).alias(f"_row_{side}"), copied.alias(f"_copy_{side}"),
        F.when(dealt, F.array(own_salt)).when(copied, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))).alias("_salts"))
    return rows.select(*[qcol(c) for c in rows.columns if c != "_salts"], F.explode("_salts").alias(f"_salt_{side}"))


def reconcile(
    source: DataFrame,
    external: DataFrame,
    key: str | tuple[str, str] | Sequence,
    attributes,
    primary_key: str | None = None,
    external_source: str = "external_ref",
    publish_date: str | None = "publish_date",
    run_ts=None,
    how: str = "full_outer",
    heavy_rows: int = 100_000,
    salts: int = 32,
) -> DataFrame:
    """Attribute-level comparison; ``key`` is ``'src=ext'``, ``'src<=>ext'`` (null matches null) or
    ``(src, ext)``, or a list of these for a composite key; ``attributes`` a list of ``'src=ext'`` or
    ``(src, ext)`` pairs; ``primary_key`` the source column (or list of columns, shown as a JSON
    array of texts) reported as ``primary_key_value``, by default the source side of the key. Finding heavy
    keys runs one aggregation per side when the comparison is built."""
    if how not in ("full_outer", "left"):
        raise ValueError("how must be 'full_outer' or 'left'")
    parts = [(resolve_name(source, a), resolve_name(external, b), safe) for a, b, safe in _key_parts(key)]
    attrs = _pairs(attributes)
    named = primary_key or [a for a, _, _ in parts]
    pks = [resolve_name(source, c) for c in ([named] if isinstance(named, str) else named)]
    s_attrs = [resolve_name(source, a) for a, _ in attrs]
    e_attrs = [resolve_name(external, b) for _, b in attrs]
    pub = resolve_name(external, publish_date) if publish_date else None

    s_cols = list(dict.fromkeys([*pks, *(a for a, _, _ in parts), *s_attrs]))
    e_cols = list(dict.fromkeys([*(b for _, b, _ in parts), *e_attrs, *([pub] if pub else [])]))
    src = prefix_columns(source, "src_", s_cols)
    ext = prefix_columns(external, "ext_", e_cols)
    types = [_common_type(field_type(source, a), field_type(external, b), source.sparkSession) for a, b, _ in parts]
    sides = []
    for df, prefix, names in ((src, "src_", [a for a, _, _ in parts]), (ext, "ext_", [b for _, b, _ in parts])):
        matchable = F.lit(True)
        for name, (_, _, safe) in zip(names, parts):
            matchable = matchable if safe else matchable & qcol(prefix + name).isNotNull()
        key_hash = _hash([qcol(prefix + name) for name in names], types)
        sides.append((df, key_hash, matchable, _heavy_hashes(df, key_hash, matchable, heavy_rows)))
    left = _salted(*sides[0][:3], sides[0][3], sides[1][3], "s", salts)
    right = _salted(*sides[1][:3], sides[1][3], sides[0][3], "e", salts)
    meets = F.col("_salt_s") == F.col("_salt_e")
    for a, b, safe in parts:
        sk, ek = qcol("src_" + a), qcol("ext_" + b)
        meets = meets & (sk.eqNullSafe(ek) if safe else sk == ek)
    joined = left.join(right, meets, how)
    # _row is true on every row of a side, so it is null where the side is missing
    joined = joined.where(
        ~(F.coalesce("_copy_s", F.lit(False)) & F.col("_row_e").isNull())
        & ~(F.coalesce("_copy_e", F.lit(False)) & F.col("_row_s").isNull()))

    structs = [
        F.struct(
            F.lit(a).alias("attribute_name"),
            qcol("src_" + sa).cast("string").alias("current_value"),
            qcol("ext_" + ea).cast("string").alias("expected_value"),
        )
        for (a, _), sa, ea in zip(attrs, s_attrs, e_attrs)
    ]
    run_date = _run_date(run_ts)
    pk_texts = [qcol("src_" + c).cast("string") for c in pks]
    pk_value = pk_texts[0] if len(pks) == 1 else F.when(F.col("_row_s"), F.to_json(F.array(*pk_texts)))
    out = joined.select(
        pk_value.alias("primary_key_value"),
        (qcol("ext_" + pub) if pub else F.lit(None).cast("date")).alias("external_data_publish_date"),
        F.inline(F.array(*structs)),
    )
    return out.select(
        F.lit(named if isinstance(named, str) else ",".join(named)).alias("primary_key"),
        "primary_key_value",
        "attribute_name",
        "current_value",
        "expected_value",
        F.lit(external_source).alias("external_data_source"),
        "external_data_publish_date",
        run_date.alias("run_date"),
        F.year(run_date).alias("year"),
        F.month(run_date).alias("month"),
        F.dayofmonth(run_date).alias("day"),
    )


def reconcile_from_mapping(source: DataFrame, external: DataFrame, mapping: Mapping, run_ts=None,
                           how: str = "full_outer") -> DataFrame:
    """The mapping document form ``{external_entity, source_primary_key,
    primary_key_mapping: 'src=ext', src_ext_mapping: ['src=ext', ...]}``; ``primary_key_mapping`` may be a
    list of key parts, ``source_primary_key`` a list of columns."""
    return reconcile(
        source,
        external,
        mapping["primary_key_mapping"],
        mapping["src_ext_mapping"],
        primary_key=mapping.get("source_primary_key"),
        external_source=mapping.get("external_entity", "external_ref"),
        publish_date=mapping.get("publish_date", "publish_date"),
        run_ts=run_ts,
        how=how,
    )


def differences(recon: DataFrame) -> DataFrame:
    """Rows whose current and expected values differ (null-safe)."""
    return recon.filter(~F.col("current_value").eqNullSafe(F.col("expected_value")))
