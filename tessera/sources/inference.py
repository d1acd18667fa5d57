"""CSV without a schema: types from the values, and values that break a schema.

Inference is an aggregate. Types form a lattice: int within bigint within double,
date within timestamp_ntz, boolean apart, string above all. A scan counts, for each column,
the values that each type can hold; counts add up over tasks, so one pass over all rows
gives the schema together with its evidence, and no sample decides it. A column gets
the narrowest type that holds all of its values; one without any is a string.

A value that a given schema cannot hold goes to the quarantine: ``split_malformed``
parts the rows into those that convert whole and the others, which keep their raw
text and the names of the columns at fault.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.sources.files import csv_options, read_csv

# From narrow to wide; a column takes the first type that holds all of its values.
LATTICE = ("int", "bigint", "double", "boolean", "date", "timestamp_ntz")
_WHOLE = r"^[+-]?\d+$"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?Infinity$|^NaN$"
_DATE = r"^\d{4}-\d{1,2}-\d{1,2}$"
_TIME = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,6})?)?)?$"
_SHAPES = {"int": _WHOLE, "bigint": _WHOLE, "double": _NUMBER, "boolean": "(?i)^(true|false)$", "date": _DATE, "timestamp_ntz": _TIME}


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def read_csv_text(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    """Every column of CSV files with a header as text; empty fields are null. The
    names come from the first file, and files with other names fail the read."""
    names = spark.read.options(sep=sep, header="true", inferSchema="false").csv(path).columns
    schema = ", ".join("`" + n.replace("`", "``") + "` STRING" for n in names)
    return spark.read.schema(schema).options(**csv_options(sep)).csv(path)


def column_evidence(raw: DataFrame) -> DataFrame:
    """One row a column, by place: its name, type, values, nulls, and how many values
    each type of the lattice holds."""
    counts = []
    for place, name in enumerate(raw.columns):
        value = _quoted(name)
        held = [F.count_if(value.rlike(_SHAPES[t]) & value.try_cast(t).isNotNull()).alias(t) for t in LATTICE]
        counts.append(F.struct(F.lit(place).alias("place"), F.lit(name).alias("column"), F.count(value).alias("n_values"),
                               F.count_if(value.isNull()).alias("n_nulls"), F.struct(*held).alias("held")))
    rows = raw.agg(F.array(*counts).alias("columns")).select(F.inline("columns"))
    type_ = F.lit("string")
    for t in reversed(LATTICE):
        type_ = F.when((F.col(f"held.{t}") == F.col("n_values")) & (F.col("n_values") > 0), t).otherwise(type_)
    return rows.select("place", "column", type_.alias("type"), "n_values", "n_nulls", "held.*")


def read_csv_inferred(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    """CSV files with a header, every column in its inferred type."""
    found = column_evidence(read_csv_text(spark, path, sep)).orderBy("place").collect()  # one row a column
    schema = ", ".join("`" + r["column"].replace("`", "``") + "` " + r["type"] for r in found)
    return read_csv(spark, path, schema, sep)


def split_malformed(raw: DataFrame, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantine) of text columns under a schema of the same names: rows whose
    values all convert, in their types; and the other rows, as text, with
    ``bad_columns``, the names of the columns whose value does not convert. Empty
    fields are null and convert."""
    schema = schema if isinstance(schema, StructType) else raw.sparkSession.createDataFrame([], schema).schema
    typed = {f.name: _quoted(f.name).try_cast(f.dataType) for f in schema.fields}
    faults = [F.when(_quoted(n).isNotNull() & c.isNull(), F.lit(n)) for n, c in typed.items()]
    bad = F.array_compact(F.array(*faults))
    rows = raw.where(F.size(bad) == 0).select(*[c.alias(n) for n, c in typed.items()])
    return rows, raw.withColumn("bad_columns", bad).where(F.size("bad_columns") > 0)
