"""Session helpers.

Library code never builds its own session: the caller supplies one. The
helpers here are for tests, the bench and local runs, plus the lookup of the
shared folder used to cut lineage (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "tessera",
    event_log_dir: str | None = None,
    scratch_dir: str | None = None,
) -> SparkSession:
    """A local session configured like the tests and the bench expect.
    With ``event_log_dir`` Spark writes its event log there (stage and task
    times for ``scripts/stage_times.py``; the web UI stays off).
    ``scratch_dir`` is the folder for checkpoints and staged copies; by default
    a new folder below the system's temporary one."""
    builder = SparkSession.builder
    if scratch_dir:
        builder = builder.config(CHECKPOINT_CONF, scratch_dir)
    if event_log_dir:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_local_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_local_checkpoint_dir(spark: SparkSession) -> str:
    """Set a fresh checkpoint folder, but only when none is configured and the
    session runs in local mode (tests, bench). A cluster must name a shared
    folder in ``spark.checkpoint.dir``; this never invents one there."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder for this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-ckpt-"))
    return sc.getCheckpointDir()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``SparkContext.getCheckpointDir`` or
    ``spark.checkpoint.dir``); raises when neither is set, so a cluster job
    never falls back to a machine-local folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    raise RuntimeError(f"no checkpoint folder: set {CHECKPOINT_CONF} to a shared folder")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def temporary_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared checkpoint folder; what is written there is
    deleted when the driver's JVM ends."""
    path = scratch_path(spark, label)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path
