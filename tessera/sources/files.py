"""File sources: CSV with a fixed schema, text lines, literal rows.

CSV schemas bind by position, so a header that does not match the schema
would silently shift every later column. ``read_csv`` therefore sets
``enforceSchema=false``: Spark checks the header against the schema and fails
on a mismatch instead of returning NULL-filled columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def csv_options(sep: str = ",", header: bool = True) -> dict[str, str]:
    """Reader options with a schema, for batch and stream alike: the header is
    checked against it, and malformed values fail the read rather than become NULL."""
    return {"sep": sep, "header": str(header).lower(), "enforceSchema": "false", "mode": "FAILFAST"}


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    infer_schema: bool = False,
) -> DataFrame:
    """CSV scan (comma or any delimiter). With a schema the header is checked
    against it; without one, ``infer_schema=True`` costs an extra pass over
    the files and is meant for exploration only."""
    if schema is not None:
        return spark.read.schema(schema).options(**csv_options(sep, header)).csv(path)
    return spark.read.options(sep=sep, header=header, inferSchema=infer_schema).csv(path)


# Fixed value: the column layout of the game-sales file (declared order). ``Year`` is read as
# text because the file holds 'N/A' years; ``typed_year`` turns it into an
# integer with try_cast, so an ANSI session drops such rows in a year filter
# instead of failing.
GAME_SALES_SCHEMA = (
    "Rank INT, Name STRING, Platform STRING, Year STRING, Genre STRING, Publisher STRING, "
    "NA_Sales DOUBLE, EU_Sales DOUBLE, JP_Sales DOUBLE, Other_Sales DOUBLE, Global_Sales DOUBLE"
)


def typed_year(df: DataFrame, column: str = "Year") -> DataFrame:
    return df.withColumn(column, F.col(column).try_cast("int"))


def read_game_sales(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return typed_year(read_csv(spark, path, GAME_SALES_SCHEMA))


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> str:
    """Write a DataFrame as a folder of CSV part files (one per partition)."""
    df.write.mode("error").option("sep", sep).option("header", str(header).lower()).csv(path)
    return path


def read_text_lines(spark: SparkSession, path: str | Sequence[str], column: str = "value") -> DataFrame:
    """One row per line of the text files under ``path`` (folder or glob)."""
    df = spark.read.text(path)
    return df if column == "value" else df.withColumnRenamed("value", column)


def read_text_by_language(spark: SparkSession, paths: dict[str, str], column: str = "text") -> DataFrame:
    """Lines of several text globs, tagged with the language that names each
    glob (one scan per language, combined by name)."""
    frames = [
        read_text_lines(spark, glob, column).withColumn("lang", F.lit(lang)) for lang, glob in paths.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def literal_rows(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    """A small DataFrame from in-memory rows (tuples, dicts, Row or dataclass
    instances) with an explicit schema, so types never depend on inference."""
    prepared = []
    for row in rows:
        if hasattr(row, "__dataclass_fields__"):
            row = tuple(getattr(row, f) for f in row.__dataclass_fields__)
        prepared.append(row)
    return spark.createDataFrame(prepared, schema)
