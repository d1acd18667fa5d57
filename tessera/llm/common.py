"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_local_checkpoint_dir, temporary_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# A file or table that goes to every executor may not be larger than this.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def col(name: str) -> Column:
    """The column of exactly this name (dots and backticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, *names: str) -> list[Column]:
    """All columns of ``df`` except those that an operator's output replaces.
    Column names are compared without case, as Spark resolves them."""
    taken = {n.lower() for n in names}
    return [col(c) for c in df.columns if c.lower() not in taken]


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not use."""
    used = {c.lower() for c in df.columns}
    name = f"_{base}"
    while name.lower() in used:
        name = "_" + name
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased; every other character stays."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def utf8(text: Column) -> Column:
    """The UTF-8 bytes of a text; null gives no bytes."""
    return F.coalesce(text.cast("string").cast("binary"), F.lit(b"").cast("binary"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back. Unlike
    ``checkpoint()`` the plan runs once. The folder goes when the driver's
    JVM ends."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted when the driver's JVM ends."""
    ensure_local_checkpoint_dir(spark)
    return temporary_path(spark, label)


def broadcast_file(spark: SparkSession, path: str, max_bytes: int = MAX_BROADCAST_BYTES):
    """Broadcast a file of the driver's machine, of a checked size, so that
    executors need no copy of their own."""
    with open(path, "rb") as f:
        data = f.read(max_bytes + 1)
    if len(data) > max_bytes:
        raise ValueError(f"{path} has more than {max_bytes} bytes")
    return spark.sparkContext.broadcast(data)
