"""Results that stay: an idempotent, growing table of results by run.

``write_results`` stores any result table (metrics, rule metrics, check results, profiles, reconciliations) of a run under
``path/run_id=...``. A run that is written again replaces its own rows and no other's (dynamic partition overwrite), so a
retried job leaves the table as if it had run once. Later runs may bring new columns; rows of earlier runs have null
there. A column that changes its type is refused before anything is written.

``read_results`` reads some or all runs (other runs' files are not read) and ``history`` sets each value beside that of
the run before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RUN = "run_id"


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder) or not any(s.getPath().getName().startswith(f"{RUN}=") for s in files.listStatus(folder)):
        return None
    # run ids are text, whatever they look like
    return spark.read.option("mergeSchema", "true").option("basePath", path).schema(_schema(spark, path)).parquet(path)


def _schema(spark: SparkSession, path: str) -> str:
    """Columns of all runs, as DDL, with a text run id."""
    merged = spark.read.option("mergeSchema", "true").parquet(path)
    fields = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in merged.schema.fields if f.name != RUN]
    return ", ".join([*fields, f"{RUN} string"])


def write_results(results: DataFrame, path: str, run_id: str) -> None:
    """Store ``results`` as run ``run_id`` (replacing that run)."""
    if not run_id:
        raise ValueError("a run needs an id")
    if RUN in [c.lower() for c in results.columns]:
        raise ValueError(f"the results have a column {RUN} already")
    old = _stored(results.sparkSession, path)
    if old is not None:
        known = {f.name.lower(): f.dataType for f in old.schema.fields}
        changed = [f"{f.name}: {known[f.name.lower()].simpleString()} -> {f.dataType.simpleString()}"
                   for f in results.schema.fields if f.name.lower() in known and known[f.name.lower()] != f.dataType]
        if changed:
            raise ValueError(f"columns change their type: {', '.join(changed)}")
    rows = results.withColumn(RUN, F.lit(run_id))
    if results.isEmpty():  # an empty partition replaces nothing by itself
        results.write.mode("overwrite").parquet(f"{path}/{RUN}={_escaped(results.sparkSession, run_id)}")
        return
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN).parquet(path)


def _escaped(spark: SparkSession, value: str) -> str:
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def read_results(spark: SparkSession, path: str, runs: Sequence[str] | None = None) -> DataFrame:
    """The stored rows with their ``run_id``, of all runs or of ``runs``."""
    out = _stored(spark, path)
    if out is None:
        raise ValueError(f"no results in {path}")
    return out if runs is None else out.where(F.col(RUN).isin(list(runs)))


def history(results: DataFrame, keys: Sequence[str], value: str = "value", order: str | Column = RUN) -> DataFrame:
    """The rows with ``previous`` (the same keys' value in the run before), ``change`` and ``run_number`` (from 1)."""
    by = Window.partitionBy(*keys).orderBy(order)
    out = results.withColumns({"previous": F.lag(value).over(by), "run_number": F.row_number().over(by)})
    return out.withColumn("change", F.col(value) - F.col("previous"))
