"""Result folders of streams: whole versions of keyed partitions, with commits.

A folder holds ``v<epoch>/bucket=<b>`` (the rows of bucket b as micro-batch
``epoch`` left them) and ``commit<epoch>``, a small file that names the current
version of every bucket. A commit is written under another name first and then
renamed, so readers see whole commits only; a replayed micro-batch writes its own
version and commit again, on top of the commit before it. The last two commits and
what they name stay, older versions are deleted.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

COMMIT, VERSION, BUCKET = "commit", "v", "bucket"
KEPT_COMMITS = 2


class Commit(NamedTuple):
    epoch: int
    schema: StructType
    buckets: dict[int, int]  # bucket: the epoch that wrote it last


def _files(spark: SparkSession, root: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _epochs(spark: SparkSession, root: str, prefix: str) -> list[int]:
    fs, path = _files(spark, root)
    if not fs.exists(path(root)):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path(root))]
    return sorted(int(n.removeprefix(prefix)) for n in names if n.startswith(prefix) and n.removeprefix(prefix).lstrip("-").isdigit())


def last_commit(spark: SparkSession, root: str, before: int | None = None) -> Commit | None:
    """The latest commit, or the latest of an epoch before ``before``."""
    epochs = [e for e in _epochs(spark, root, COMMIT) if before is None or e < before]
    return _read(spark, root, epochs[-1]) if epochs else None


def _read(spark: SparkSession, root: str, epoch: int) -> Commit:
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
    fs, path = _files(spark, root)
    stream = fs.open(path(f"{root}/{COMMIT}{epoch}"))
    try:
        found = json.loads(text.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Commit(epoch, StructType.fromJson(found["schema"]), {int(b): e for b, e in found["buckets"].items()})


def read_buckets(spark: SparkSession, root: str, commit: Commit, buckets: set[int] | None = None) -> DataFrame:
    """The rows of some buckets (or all) as the commit names them."""
    chosen = sorted((b, e) for b, e in commit.buckets.items() if buckets is None or b in buckets)
    if not chosen:
        return spark.createDataFrame([], commit.schema)
    return spark.read.schema(commit.schema).parquet(*[f"{root}/{VERSION}{e}/{BUCKET}={b}" for b, e in chosen])


def write_version(rows: DataFrame, root: str, epoch: int) -> set[int]:
    """Write the buckets of ``rows`` (column ``bucket``) as a version of the epoch."""
    target = f"{root}/{VERSION}{epoch}"
    rows.write.mode("overwrite").partitionBy(BUCKET).parquet(target)
    fs, path = _files(rows.sparkSession, root)
    names = [f.getPath().getName() for f in fs.listStatus(path(target))]
    return {int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}=")}


def commit(spark: SparkSession, root: str, new: Commit) -> None:
    """Make a version current, then delete what only older commits name."""
    fs, path = _files(spark, root)
    final, draft = path(f"{root}/{COMMIT}{new.epoch}"), path(f"{root}/.{COMMIT}{new.epoch}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps({"schema": new.schema.jsonValue(), "buckets": new.buckets}).encode()))
    out.close()
    fs.delete(final, False)
    if not fs.rename(draft, final):
        raise OSError(f"cannot rename {draft.toString()}")
    epochs = [e for e in _epochs(spark, root, COMMIT) if e <= new.epoch]
    kept, old = epochs[-KEPT_COMMITS:], epochs[:-KEPT_COMMITS]
    needed = {e for k in kept for e in _read(spark, root, k).buckets.values()} | {new.epoch}
    for e in old:
        fs.delete(path(f"{root}/{COMMIT}{e}"), False)
    for e in _epochs(spark, root, VERSION):
        if e <= new.epoch and e not in needed:
            fs.delete(path(f"{root}/{VERSION}{e}"), True)
