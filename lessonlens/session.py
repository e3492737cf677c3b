"""Session construction and the runtime SQL settings the plans rely on."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import threading

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings.  They change plans, never results.
#
# * AQE re-plans joins from real shuffle sizes, coalesces small partitions and
#   splits skewed ones.
# * requireAllClusterKeysForCoPartition=false lets a join on (user_id, lesson_id)
#   reuse a hash partitioning on user_id alone, so the user x lesson fan-out is
#   never re-shuffled between the completion join and the per-user roll-ups.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (idempotent)."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


# Most user x lesson rows that one partition of the user-keyed relations may come to hold, and
# log rows for each partition of the other exchanges.
FAN_OUT_ROWS = 1_000_000
LOG_ROWS = 500_000
# Most shuffled bytes that AQE merges into one task.  Log rows take ten times that or more once they are
# hashed by user and lesson: Spark's own 64 MB come to over 700 MB of memory.
MERGED_BYTES = "16m"
_DEALT = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def deal(spark: SparkSession, log_rows: int) -> None:
    """Sizes the session's exchanges by the activity logs: AQE merges small partitions, but never deals
    more of them than it began with, so a fixed number would let a task's share grow with the data.
    What it merges is held to ``MERGED_BYTES``, unless the session has a size of its own."""
    if spark.conf.get(_MERGED, None) is None:
        spark.conf.set(_MERGED, MERGED_BYTES)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-log_rows // LOG_ROWS))
    if spark.conf.get(_DEALT, None) != str(n):
        spark.conf.set(_DEALT, str(n))


def user_partitions(spark: SparkSession, fan_out: int = 0) -> int:
    """Partition count of the user-keyed relations (``lessonlens.userPartitions``, default
    ``spark.sql.shuffle.partitions``, and so many that none holds more than ``FAN_OUT_ROWS`` of
    the ``fan_out``: the user x lesson rows, not the users themselves, fill a task's memory).
    Not less than those of other exchanges, for which Spark would give up this partitioning."""
    value = spark.conf.get("lessonlens.userPartitions", None)
    if value:
        return int(value)
    plain = spark.conf.get("spark.sql.shuffle.partitions")
    return max(int(plain), int(spark.conf.get(_DEALT, None) or plain), -(-fan_out // FAN_OUT_ROWS))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a scratch one only if unset.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared file
    system); a local scratch folder is used only for local test sessions.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="lessonlens-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)      # ours alone: a local run's scratch
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def get_session(cpus: int | str = "*", shuffle_partitions: int | None = None,
                app_name: str = "lessonlens") -> SparkSession:
    """Local session for tests and the bench; clusters pass their own session."""
    parts = shuffle_partitions or (8 if cpus == "*" else max(int(cpus), 1))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.driver.memory", os.environ.get("LESSONLENS_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_AQE_LOCK = threading.Lock()


def checkpoint_partitioned(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Hash-partition ``df`` on ``key`` and checkpoint it (eagerly, into the
    session's ``spark.checkpoint.dir``), keeping the partitioning visible to
    the planner.

    Later joins and aggregates keyed on ``key`` reuse the partitioning (no
    shuffle), every branch of a plan reads the same files (no per-branch
    re-shuffle after column pruning), and the lineage is cut.  The checkpoint
    job itself runs with AQE off: under AQE the root's partitioning is not
    known yet when the checkpoint records it, and it would be lost.  Its other
    exchanges then have the fixed number of partitions, which is raised to that of ``df``.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or user_partitions(spark)
    with _AQE_LOCK:
        before = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", str(max(n, int(before["spark.sql.shuffle.partitions"]))))
        try:
            return df.repartition(n, key).checkpoint(eager=True)
        finally:
            for c, value in before.items():
                spark.conf.set(c, value)
