"""Daily sales totals over a folder of arriving CSV files.

``readStream`` over the folder (explicit schema -- a stream cannot infer
one -- with the header checked against it) and a stateful group-by on the day. State
is kept by RocksDB with changelog checkpoints: a micro-batch uploads what it changed,
not the whole state, and the state may outgrow an executor's memory.

Two sinks write whole, committed versions (``tessera.streaming.versions``):

- the daily table runs in update mode: a micro-batch emits the days that it changed,
  and the sink merges these into the buckets that hold them. Other buckets keep their
  files, so a batch costs what it changed and not what the table holds;
- the top-k view runs in complete mode (sorted, then limited) and rewrites its k rows.

State and progress live in a checkpoint folder under the shared
``spark.checkpoint.dir``, so a restarted query resumes where it stopped; a replayed
micro-batch writes its version again.

The state holds one row per distinct day and has no expiry; a watermark is
not used because the totals are over all time. The aggregate is partial +
final like a batch aggregate, so a day holding a large share of the rows is
combined in each task before the state update. The number of state
partitions is ``state_partitions`` (by default ``spark.sql.shuffle.partitions``) at the
first start and is kept in the checkpoint (AQE does not change it): size it for the
number of days, of which every task sends one partial row each, not for the rows.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tessera.session import temporary_path
from tessera.sources.files import csv_options
from tessera.streaming import versions

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
RESULT_BUCKETS = 8


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the start of a query, which keeps a copy of them."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_csv_stream(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    sep: str = ",",
    header: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming DataFrame over the CSV files of ``folder``."""
    reader = spark.readStream.format("csv").schema(schema).options(**csv_options(sep, header))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(folder)


def daily_sales(stream: DataFrame, day_col: str | Column, quantity_col: str, price_col: str) -> DataFrame:
    """Streaming aggregate: ``day``, ``total_sales`` (rounded to cents).
    ``day_col`` is a column name (its date is taken) or a day expression."""
    day = day_col if isinstance(day_col, Column) else F.to_date(F.col(day_col))
    return stream.groupBy(day.alias("day")).agg(
        F.round(F.sum(F.col(quantity_col) * F.col(price_col)), 2).alias("total_sales")
    )


def read_result(spark: SparkSession, result_path: str) -> DataFrame:
    """The table of the last committed micro-batch."""
    last = versions.last_commit(spark, result_path)
    if last is None:
        raise FileNotFoundError(f"no committed result in {result_path}")
    return versions.read_buckets(spark, result_path, last)


@dataclass
class StreamRun:
    query: StreamingQuery
    result_path: str
    checkpoint_path: str

    def finish(self, timeout_sec: float | None = None) -> None:
        """Wait for a query that ends by itself, and raise what ended it badly."""
        if timeout_sec is None:
            self.query.awaitTermination()
        elif not self.query.awaitTermination(timeout_sec):
            self.query.stop()
            raise TimeoutError(f"stream did not finish within {timeout_sec} s")
        if self.query.exception() is not None:
            raise RuntimeError(str(self.query.exception()))

    def drain(self, batches: int, poll_sec: float = 0.05) -> int:
        """Wait until the running query has finished so many micro-batches since its
        start, or has nothing left to read; how many it has finished."""
        while self.query.isActive:
            status, progress = self.query.status, self.query.recentProgress
            done = sum(1 for p in progress if p["numInputRows"])
            if done >= batches or (progress and not status["isDataAvailable"] and not status["isTriggerActive"]):
                return done
            time.sleep(poll_sec)
        self.finish()
        return sum(1 for p in self.query.recentProgress if p["numInputRows"])


def run_to_parquet(
    agg: DataFrame,
    result_path: str,
    checkpoint_path: str,
    name: str | None = None,
    available_now: bool = True,
    interval: str = "10 seconds",
    key_cols: tuple[str, ...] | None = ("day",),
    buckets: int = RESULT_BUCKETS,
    state_partitions: int | None = None,
) -> StreamRun:
    """Start ``agg``. With ``key_cols`` in update mode: changed rows are merged by key
    into ``buckets`` partitions of the result. Without in complete mode: each
    micro-batch writes the full (sorted, limited) table. ``available_now`` processes
    what is there and stops; otherwise the query keeps running and checks for new
    files every ``interval`` until stopped."""
    spark, schema = agg.sparkSession, agg.schema
    bucket = F.pmod(F.xxhash64(*key_cols), F.lit(buckets)).cast("int") if key_cols else F.lit(0)

    def merge(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        before = versions.last_commit(session, result_path, before=epoch)
        current = before.buckets if before else {}
        rows = batch.withColumn(versions.BUCKET, bucket)
        if not key_cols:
            written = versions.write_version(rows, result_path, epoch)
            versions.commit(session, result_path, versions.Commit(epoch, schema, dict.fromkeys(written, epoch)))
            return
        rows = rows.persist()  # the stateful plan runs once
        try:
            changed = {r[0] for r in rows.select(versions.BUCKET).distinct().collect()}  # at most ``buckets``
            if before and changed & set(current):
                old = versions.read_buckets(session, result_path, before, changed).withColumn(versions.BUCKET, bucket)
                same = [old[k].eqNullSafe(rows[k]) for k in (versions.BUCKET, *key_cols)]
                whole = old.join(rows, same, "left_anti").unionByName(rows)
            else:
                whole = rows
            # Each bucket in one file: its rows meet in one task.
            written = versions.write_version(whole.repartition(buckets, versions.BUCKET), result_path, epoch)
        finally:
            rows.unpersist()
        versions.commit(session, result_path, versions.Commit(epoch, schema, current | dict.fromkeys(written, epoch)))

    if versions.last_commit(spark, result_path) is None:  # an empty table until the first micro-batch
        versions.commit(spark, result_path, versions.Commit(-1, schema, {}))
    writer = (
        agg.writeStream.outputMode("update" if key_cols else "complete")
        .foreachBatch(merge)
        .option("checkpointLocation", checkpoint_path)
    )
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    partitions = {"spark.sql.shuffle.partitions": str(state_partitions)} if state_partitions else {}
    with _settings(spark, STATE_SETTINGS | partitions):
        return StreamRun(writer.start(), result_path, checkpoint_path)


def stream_daily_sales(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    day_col: str | Column,
    quantity_col: str,
    price_col: str,
    sep: str = ",",
    max_files_per_trigger: int | None = 1,
    timeout_sec: float | None = None,
    top_k: int | None = None,
    name: str | None = None,
    result_path: str | None = None,
    checkpoint_path: str | None = None,
    **sink,
) -> DataFrame:
    """Process every file now in ``folder`` (one or more micro-batches),
    wait for the stream to finish and return the final table as a batch
    DataFrame read back from the result folder. With ``top_k`` the stream
    itself keeps only the k best days (sorted, then limited, in complete
    mode: the live view is the true top, not the first rows to arrive).
    Passing the ``checkpoint_path`` (and ``result_path``) of an earlier run
    resumes it: only files not yet seen are read, on top of the saved state.
    There is no time limit unless ``timeout_sec`` sets one; ``sink`` holds further
    options of ``run_to_parquet`` (``buckets``, ``state_partitions``)."""
    stream = read_csv_stream(spark, folder, schema, sep, True, max_files_per_trigger)
    agg = daily_sales(stream, day_col, quantity_col, price_col)
    if top_k is not None:
        agg = top_days(agg, top_k)
    run = run_to_parquet(
        agg,
        result_path or temporary_path(spark, "stream-result"),
        checkpoint_path or temporary_path(spark, "stream-state"),
        name=name,
        key_cols=("day",) if top_k is None else None,
        **sink,
    )
    run.finish(timeout_sec)
    return read_result(spark, run.result_path)


def stop_and_resume_daily_sales(
    spark: SparkSession,
    folder: str,
    schema: StructType | str,
    day_col: str | Column,
    quantity_col: str,
    price_col: str,
    name: str,
    stop_after: int,
    sep: str = ",",
    max_files_per_trigger: int | None = 1,
    **sink,
) -> tuple[DataFrame, int, int]:
    """Run the live query under ``name`` until it has finished ``stop_after``
    micro-batches, find it by its name and stop it, then start it again from its
    checkpoint for what is left. The final table, and the micro-batches with rows of
    the first and of the second run."""
    stream = read_csv_stream(spark, folder, schema, sep, True, max_files_per_trigger)
    agg = daily_sales(stream, day_col, quantity_col, price_col)
    result, state = temporary_path(spark, "stream-result"), temporary_path(spark, "stream-state")
    first = run_to_parquet(agg, result, state, name, available_now=False, interval="0 seconds", **sink)
    try:
        first.drain(stop_after)
    finally:
        stop_query_by_name(spark, name)
    before = sum(1 for p in first.query.recentProgress if p["numInputRows"])
    rest = run_to_parquet(agg, result, state, name, **sink)
    rest.finish()
    after = sum(1 for p in rest.query.recentProgress if p["numInputRows"])
    return read_result(spark, result), before, after


def agreement(left: DataFrame, right: DataFrame, key: str, value: str, names: tuple[str, str] = ("left", "right")) -> DataFrame:
    """How far two tables with one row per key agree, as one row: keys on both sides,
    those of them with equal values, and keys on one side only. Nulls are values."""
    a = left.select(F.col(key).alias("key"), F.col(value).alias("a"), F.lit(True).alias("in_a"))
    b = right.select(F.col(key).alias("key"), F.col(value).alias("b"), F.lit(True).alias("in_b"))
    both = a.join(b, a["key"].eqNullSafe(b["key"]), "full_outer").select("a", "b", "in_a", "in_b")
    paired = F.col("in_a").isNotNull() & F.col("in_b").isNotNull()
    return both.agg(
        F.count_if(paired).alias("keys_on_both"),
        F.count_if(paired & F.col("a").eqNullSafe(F.col("b"))).alias("equal_values"),
        F.count_if(F.col("in_b").isNull()).alias(f"only_{names[0]}"),
        F.count_if(F.col("in_a").isNull()).alias(f"only_{names[1]}"),
    )


def top_days(table: DataFrame, k: int) -> DataFrame:
    """The ``k`` best days of a daily table (sorted before the limit, so the
    view is the true top, not the first rows that happen to arrive)."""
    return table.orderBy(F.desc("total_sales"), F.asc("day")).limit(k)


def stop_query_by_name(spark: SparkSession, name: str) -> bool:
    """Stop the active streaming query called ``name``; False if none runs."""
    for q in spark.streams.active:
        if q.name == name:
            q.stop()
            return True
    return False
