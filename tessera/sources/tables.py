"""Parquet tables of a scale-factor folder (one ``<name>.parquet`` per table).

Reads are lazy; Catalyst prunes columns and pushes filters into the scan, so
callers select only what they need and the scan reads only those columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLE_NAMES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(
    spark: SparkSession, sf_dir: str, name: str, schema: StructType | str | None = None, columns=None
) -> DataFrame:
    """Parquet scan of one table, optionally with an imposed schema and an
    early column list (both only narrow what the scan reads)."""
    if name not in TABLE_NAMES:
        raise KeyError(f"unknown table {name!r}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


class Tables:
    """Attribute access to the tables of one folder: ``Tables(spark, d).lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return read_table(self.spark, self.sf_dir, name)
        raise AttributeError(name)
