"""Shared frequency tables: one shuffle for the value counts of many key sets.

``frequencies(df, key_sets)`` returns ``(k int, v string, nn boolean, n long)``: for key set
number ``k``, each distinct key value ``v`` (text; multi-column keys as a JSON object),
whether any key part is non-null (``nn``) and its row count ``n``. Null is a value of its
own.

Several key sets share ONE scan. Each input row is fanned out with ``inline`` into one
element per key set; the key columns go into *typed slots* shared by type and position
(key set ``(a long)`` and ``(b long, c string)`` use slots ``long_0``, ``long_1`` and
``string_0``), the other slots stay null. Grouping is therefore on native values (no text
conversion per input row), the element width is bounded by the number of distinct slot
types rather than the number of columns, and the text of a key is produced only for the
distinct values, after aggregation (and only when a consumer reads ``v``). Partial
aggregation before the shuffle collapses hot values, so a value holding a third of the
table costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualia.functions.predicates import COMPLEX_TYPES, as_text, qcol


def normalize_key_sets(df: DataFrame, key_sets, fields: dict | None = None) -> list[tuple[str, ...]]:
    fields = fields if fields is not None else {f.name.lower(): f for f in df.schema.fields}
    out = []
    for ks in key_sets:
        cols = []
        for c in (ks,) if isinstance(ks, str) else tuple(ks):
            f = fields.get(c.lower())
            if f is None:
                raise KeyError(f"no column {c!r} in {df.columns}")
            if isinstance(f.dataType, COMPLEX_TYPES):
                raise TypeError(f"column {c!r} has a complex type; frequencies need atomic columns")
            cols.append(f.name)
        out.append(tuple(cols))
    return out


def _slot_name(type_name: str, pos: int) -> str:
    return "s_" + "".join(ch if ch.isalnum() else "_" for ch in type_name) + f"_{pos}"


def frequencies(df: DataFrame, key_sets, wheres: Sequence[str | None] | None = None) -> DataFrame:
    """Value counts for each key set (optionally each under its own ``where`` filter)."""
    fields = {f.name.lower(): f for f in df.schema.fields}
    kss = normalize_key_sets(df, key_sets, fields)
    wheres = list(wheres) if wheres is not None else [None] * len(kss)

    def field_type(_df, c):
        return fields[c.lower()].dataType

    if len(kss) == 1 and wheres[0] is None and len(kss[0]) == 1:
        # One column: plain typed grouping, text only for the distinct values.
        c = kss[0][0]
        counted = df.groupBy(qcol(c).alias("_key")).agg(F.count(F.lit(1)).alias("_count"))
        return counted.select(
            F.lit(0).alias("k"), as_text(F.col("_key"), field_type(df, c)).alias("v"),
            F.col("_key").isNotNull().alias("nn"), F.col("_count").alias("n"),
        )

    # Slot layout: (type, position-within-type) -> slot column; one layout for all key sets.
    slot_types: dict[str, object] = {}
    assign: list[list[str]] = []
    for cols in kss:
        seen: dict[str, int] = {}
        names = []
        for c in cols:
            dt = field_type(df, c)
            t = dt.simpleString()
            pos = seen.get(t, 0)
            seen[t] = pos + 1
            name = _slot_name(t, pos)
            slot_types[name] = dt
            names.append(name)
        assign.append(names)
    slots = list(slot_types)

    items = []
    for i, (cols, names, where) in enumerate(zip(kss, assign, wheres)):
        filled = dict(zip(names, cols))
        nn = F.lit(False)
        for c in cols:
            nn = nn | qcol(c).isNotNull()
        fields = [F.lit(i).alias("k"), nn.alias("nn")] + [
            (qcol(filled[s]) if s in filled else F.lit(None)).cast(slot_types[s]).alias(s) for s in slots
        ]
        s = F.struct(*fields)
        items.append(F.when(F.expr(where), s) if where else s)
    arr = F.array(*items)
    if any(wheres):
        arr = F.filter(arr, lambda x: x.isNotNull())
    counted = df.select(F.inline(arr)).groupBy("k", "nn", *slots).agg(F.count(F.lit(1)).alias("n"))

    # Text of each key, computed on distinct values only.
    text: Column | None = None
    for i, (cols, names) in enumerate(zip(kss, assign)):
        if len(cols) == 1:
            t = as_text(F.col(names[0]), slot_types[names[0]])
        else:
            t = F.to_json(
                F.struct(*[as_text(F.col(s), slot_types[s]).alias(str(j)) for j, s in enumerate(names)]), {"ignoreNullFields": "false"}
            )
            t = F.when(F.col("nn"), t)  # all parts null: the null key
        text = F.when(F.col("k") == i, t) if text is None else text.when(F.col("k") == i, t)
    return counted.select("k", text.alias("v"), "nn", "n")


def key_set_stats(freq: DataFrame) -> DataFrame:
    """Per key set: rows, non-null rows, distinct values (with null), distinct non-null, seen once."""
    return freq.groupBy("k").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("nn"), F.col("n"))), F.lit(0)).alias("nonnull_rows"),
        F.count(F.lit(1)).alias("bins"),
        F.count_if(F.col("nn")).alias("distinct_nonnull"),
        F.count_if(F.col("nn") & (F.col("n") == 1)).alias("unique_nonnull"),
    )


def key_set_table(freq: DataFrame, n_key_sets: int) -> DataFrame:
    """``key_set_stats`` for every key set ``0..n-1``, zeros where a key set has no rows
    (an empty input still yields one row per key set). Both sides hold at most n rows
    (a bound set by the caller's metric list)."""
    ids = freq.sparkSession.range(n_key_sets).select(F.col("id").cast("int").alias("k"))
    stats = key_set_stats(freq)
    zero = F.lit(0).cast("long")
    return ids.join(stats, "k", "left").select(
        "k",
        *[F.coalesce(F.col(c), zero).alias(c) for c in ("rows", "nonnull_rows", "bins", "distinct_nonnull",
                                                            "unique_nonnull")],
    )
