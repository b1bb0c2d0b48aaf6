"""File sources (S1, S2) and the small typed tables built from Python values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from qualia.functions.predicates import qcol


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, **options) -> DataFrame:
    """CSV with a header row.

    With ``schema=None`` the schema is inferred (one extra pass over the file, as the
    survey loader does); pass a schema at scale to skip that pass. Quoted empty and empty
    fields both read as null; the text ``NA`` stays a string.
    """
    reader = spark.read.option("header", "true").options(**options)
    if schema is None:
        reader = reader.option("inferSchema", "true")
    else:
        reader = reader.schema(schema)
    return reader.csv(path)


load_survey_df = read_csv
load_df = read_csv


# Columns that a checked read adds to the table's own.
ERRORS, RECORD = "_errors", "_record"


def read_csv_checked(spark: SparkSession, path: str, schema: StructType | str, **options) -> DataFrame:
    """CSV with a header row, every row of it: the typed columns, ``_errors`` and ``_record``.

    Nothing is dropped and nothing fails: a field that does not read as its type is null in its column and
    named in ``_errors`` (``name: not a type``); a row with too few or too many fields has the error
    ``malformed``. ``_record`` is a refused row's text (null for good rows): the line if it is malformed, else its
    fields as JSON. All fields are parsed as text once, in one scan, and cast from there. ``required`` columns
    can be checked by rules afterwards: an empty field is null, not an error.
    """
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    names = [f.name for f in fields]
    clash = [n for n in names if n.lower() in (ERRORS, RECORD)]
    if clash:
        raise ValueError(f"columns {clash} clash with those of the checked read; rename them")
    text = StructType([StructField(n, StringType()) for n in names] + [StructField(RECORD, StringType())])
    raw = (spark.read.option("header", "true").options(**options).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", RECORD).schema(text).csv(path))
    typed, errors = [], [F.when(qcol(RECORD).isNotNull(), F.lit("malformed"))]
    for f in fields:
        if isinstance(f.dataType, StringType):
            typed.append(qcol(f.name))
            continue
        value = F.trim(qcol(f.name)).try_cast(f.dataType)
        typed.append(value.alias(f.name))
        bad = qcol(RECORD).isNull() & qcol(f.name).isNotNull() & value.isNull()
        errors.append(F.when(bad, F.lit(f"{f.name}: not a {f.dataType.simpleString()}")))
    found = F.filter(F.array(*errors), lambda e: e.isNotNull())
    record = F.coalesce(qcol(RECORD), F.when(F.size(found) > 0, F.to_json(F.struct(*[qcol(n) for n in names]))))
    return raw.select(*typed, found.alias(ERRORS), record.alias(RECORD))


def good_rows(checked: DataFrame) -> DataFrame:
    """The rows of a checked read without errors, in the table's own columns."""
    return checked.where(F.size(ERRORS) == 0).drop(ERRORS, RECORD)


def refused_rows(checked: DataFrame) -> DataFrame:
    """``_record, _errors`` of the rows of a checked read with errors."""
    return checked.where(F.size(ERRORS) > 0).select(RECORD, ERRORS)


def quarantine(checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write a checked read once, good and refused rows apart (``path/_refused=false`` and ``true``), and return both
    as read from there: the source is scanned once for the two."""
    checked.withColumn("_refused", F.size(ERRORS) > 0).write.partitionBy("_refused").parquet(path)
    back = checked.sparkSession.read.schema(StructType([*checked.schema.fields, StructField("_refused", BooleanType())])).parquet(path)
    return good_rows(back.where("NOT _refused").drop("_refused")), refused_rows(back.where("_refused"))
