"""Session settings (survey P8) shared by tests, bench and the driver entry."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every session of the library relies on.  UTC makes hour / weekday /
# date extraction independent of the machine; AQE coalesces the tiny mart
# shuffles, converts joins to broadcast at runtime when a side proves small,
# and splits skewed join partitions (hot sessions / items / promotions).
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs a shuffle afterwards
    # (e.g. cart de-duplication reuses the semi-join's partitioning): with one
    # key holding a third of the rows, the extra shuffle is far cheaper than a
    # straggler task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


CHECKPOINT_DIR = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "clickmart", extra: dict | None = None,
                checkpoint_dir: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the library settings.

    ``master`` and ``shuffle_partitions`` are only meant for local runs; on a
    cluster the submitter decides them.  ``checkpoint_dir`` is the folder,
    shared by all executors, for written tables and checkpoints, where the
    cluster's configuration does not name one.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("CLICKMART_DRIVER_MEM", "8g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # Runtime-settable SQL options also apply to a session that existed already.
    for k, v in conf.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    if checkpoint_dir:
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    spark.sparkContext.setLogLevel("WARN")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    Named by the cluster in ``spark.checkpoint.dir``, or by the caller with
    ``SparkContext.setCheckpointDir`` (``get_session(checkpoint_dir=...)``).
    There is no fallback: a folder of one machine would hold only that
    machine's part of a table.
    """
    named = spark.sparkContext.getCheckpointDir()
    path = spark.conf.get(CHECKPOINT_DIR, None)
    if path and not named:
        spark.sparkContext.setCheckpointDir(path)
    path = path or named
    if not path:
        raise ValueError(f"no shared folder: set {CHECKPOINT_DIR}, or call get_session(checkpoint_dir=...) "
                         "or SparkContext.setCheckpointDir")
    return path


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of parquet.

    Scan splits and shuffle partitions are sized to ``target_partition_bytes``
    (256 MiB: a task's share fits comfortably in executor memory and spills
    cleanly), with at least two waves of tasks per core.  AQE starts from that
    partition count and coalesces or splits at run time.  At 100 TB on
    1000 × 8 cores this gives ~400k shuffle partitions for the event-level
    shuffles; session-level shuffles are coalesced by AQE.
    """
    cores = max(1, executors * cores_per_executor)
    partitions = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
