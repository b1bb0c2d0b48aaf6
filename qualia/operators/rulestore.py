"""Rule store as a keyed table.

The store is a DataFrame of rule documents keyed by ``(source, entity)`` (schema
``DOCUMENT_SCHEMA``); a catalogue of any size stays distributed. Lookups are filters,
whole-document writes are an anti join plus a union, and partial updates a full outer
join on the key. Write the result with ``df.write`` (for example into a table
partitioned by ``source``). Writes count their documents when they are called and deal them out by key, so many
to a task: what a task holds does not grow with the store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualia.sources.rules import DOCUMENT_SCHEMA

KEYS = ["source", "entity"]

# Fixed value: the element groups a partial update always sets.
UPDATE_RUN_ON = ["cde", "kde"]

# Documents that one task sorts (some kilobytes each). Stored documents and the rows they are made from are
# many times smaller, so neither file splits nor shuffled bytes bound this.
DOCS_A_TASK = 50_000


def document_tasks(*docs: DataFrame) -> int:
    """Number of tasks for all documents of ``docs`` (which are counted)."""
    return sum(d.count() for d in docs) // DOCS_A_TASK + 1


def _by_name(c, src: T.DataType, dst: T.DataType):
    """Convert ``c`` from ``src`` to ``dst`` matching struct fields BY NAME (a plain cast
    matches them by position, which moves values into the wrong fields when the incoming
    order differs, as with JSON read with an inferred schema)."""
    if isinstance(dst, T.StructType) and isinstance(src, T.StructType):
        have = {f.name: f.dataType for f in src.fields}
        return F.struct(
            *[
                (_by_name(c[f.name], have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
                .alias(f.name)
                for f in dst.fields
            ]
        )
    if isinstance(dst, T.ArrayType) and isinstance(src, T.ArrayType):
        return F.transform(c, lambda x: _by_name(x, src.elementType, dst.elementType))
    if isinstance(dst, T.MapType) and isinstance(src, T.MapType):
        return F.transform_values(c, lambda k, v: _by_name(v, src.valueType, dst.valueType)).cast(dst)
    return c.cast(dst)


def _conform(docs: DataFrame, order_col: str | None = None) -> DataFrame:
    """Documents with exactly the canonical columns (missing ones null), in order; nested
    rule structs are matched by field name. ``order_col`` is kept as ``_order``."""
    have = {f.name: f.dataType for f in docs.schema.fields}
    return docs.select(
        *[
            (_by_name(F.col(f.name), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
            .alias(f.name)
            for f in DOCUMENT_SCHEMA.fields
        ],
        *([F.col(order_col).alias("_order")] if order_col else []),
    )


def get_rule(store: DataFrame, source: str, entity: str | None = None) -> DataFrame:
    """The document of ``(source, entity)``, or every document of ``source``."""
    cond = F.col("source") == F.lit(source)
    if entity is not None:
        cond = cond & (F.col("entity") == F.lit(entity))
    return store.filter(cond)


def _last_per_key(docs: DataFrame, order_col: str | None, tasks: int) -> DataFrame:
    """One document per key, conformed: the last by ``order_col`` (ties and no order column: the
    greatest by its JSON text, so the choice does not depend on the input's row order). Dealt out by key
    to ``tasks`` tasks first: input tasks do not sort their documents."""
    text = F.to_json(F.struct(*[F.col(f.name) for f in DOCUMENT_SCHEMA.fields]))
    # documents of one literal source: a key that the optimizer takes for a constant is left out of the joins' keys,
    # which then shuffle the whole store again
    rows = _conform(docs, order_col).withColumn("source", F.concat("source", F.substring(F.coalesce("entity", F.lit("")), 1, 0)))
    rows = rows.repartition(tasks, *KEYS).withColumn("_text", text)
    key = F.struct(*([F.col("_order")] if order_col else []), F.col("_text"))
    best = rows.groupBy(*KEYS).agg(F.max_by(F.struct(*[F.col(f.name) for f in DOCUMENT_SCHEMA.fields if f.name not in KEYS]), key).alias("d"))
    return best.select(*KEYS, "d.*").select(*[f.name for f in DOCUMENT_SCHEMA.fields])


def put_rules(store: DataFrame, docs: DataFrame, order_col: str | None = None) -> DataFrame:
    """R2: whole-document replace by key; new keys are inserted. Of several documents for one
    key the last by ``order_col`` is written."""
    tasks = document_tasks(store, docs)
    new = _last_per_key(docs, order_col, tasks)
    kept = _conform(store).repartition(tasks, *KEYS).join(new.select(*KEYS), KEYS, "left_anti")
    return kept.unionByName(new)


def update_rules(store: DataFrame, updates: DataFrame, order_col: str | None = None) -> DataFrame:
    """Set ``single_column_profiler_rules``, ``single_column_validation_rules`` and
    ``rules_run_on = ['cde', 'kde']`` on matching keys; other attributes keep their
    values. A key missing from the store is inserted with only those attributes. Of several
    updates of one key the last by ``order_col`` is applied."""
    tasks = document_tasks(store, updates)
    conformed = _last_per_key(updates, order_col, tasks)
    upd = conformed.select(
        *KEYS,
        F.lit(True).alias("_upd"),
        F.col("single_column_profiler_rules").alias("_p"),
        F.col("single_column_validation_rules").alias("_v"),
    )
    joined = _conform(store).repartition(tasks, *KEYS).join(upd, KEYS, "full_outer")
    matched = F.coalesce(F.col("_upd"), F.lit(False))
    run_on = F.array(*[F.lit(x) for x in UPDATE_RUN_ON])
    return joined.select(
        *[
            F.when(matched, F.col("_p")).otherwise(F.col(f.name)).alias(f.name)
            if f.name == "single_column_profiler_rules"
            else F.when(matched, F.col("_v")).otherwise(F.col(f.name)).alias(f.name)
            if f.name == "single_column_validation_rules"
            else F.when(matched, run_on).otherwise(F.col(f.name)).alias(f.name)
            if f.name == "rules_run_on"
            else F.col(f.name)
            for f in DOCUMENT_SCHEMA.fields
        ]
    )


def put_rule(store: DataFrame, source: str, entity: str, cde, kde, rules_run_on, single_column_profiler_rules=None,
             single_column_validation_rules=None, **other) -> DataFrame:
    """Whole-document write of one ``(source, entity)`` given as values (R2)."""
    from qualia.sources.rules import documents_from_dicts

    doc = {
        "source": source, "entity": entity, "cde": cde, "kde": kde, "rules_run_on": rules_run_on,
        "single_column_profiler_rules": single_column_profiler_rules or None,
        "single_column_validation_rules": single_column_validation_rules or None, **other,
    }
    return put_rules(store, documents_from_dicts(store.sparkSession, [doc]))


def update_rule(store: DataFrame, source: str, entity: str, single_column_profiler_rules=None,
                single_column_validation_rules=None) -> DataFrame:
    """Partial update of one ``(source, entity)`` given as values."""
    from qualia.sources.rules import documents_from_dicts

    upd = documents_from_dicts(store.sparkSession, [{
        "source": source, "entity": entity,
        "single_column_profiler_rules": single_column_profiler_rules or None,
        "single_column_validation_rules": single_column_validation_rules or None,
    }])
    return update_rules(store, upd)


def get_rule_document(store: DataFrame, source: str, entity: str) -> dict | None:
    """The one document of ``(source, entity)`` as a dict (configuration for
    ``rules_of``); ``None`` when absent. Reads at most two rows."""
    rows = get_rule(store, source, entity).limit(2).collect()
    if not rows:
        return None
    if len(rows) > 1:
        raise ValueError(f"more than one document for ({source!r}, {entity!r})")
    return rows[0].asDict(recursive=True)
