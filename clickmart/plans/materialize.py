"""Materialised model tables (the reference builds every model as a table).

The staged rows and the fused session features are read by most marts; they
are written once per source snapshot as parquet under the shared folder named
by ``spark.checkpoint.dir`` and read back from there.  A written table cuts
the lineage (a lost executor re-reads files instead of recomputing the
binding) and gives later scans column pruning and partition pruning.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from clickmart.conf import ensure_checkpoint_dir

# For rows that come arranged: a task keeps the files of its few dates open
# instead of sorting the finished rows once more, and arrays are gathered from
# rows that a merge join has left in order, not through a hash map that
# overflows into a second sort.
ARRANGED_CONF = {"spark.sql.maxConcurrentOutputFileWriters": "64", "spark.sql.execution.useObjectHashAggregateExec": "false"}

_LOCK = threading.RLock()
_TABLES: dict[tuple[str, str], tuple[str, DataFrame]] = {}


def source_signature(spark: SparkSession, paths: Sequence[str]) -> str:
    """Identity of the input snapshot: path, size and modification time of each file.

    Read through the file system that Spark itself uses for the path, so a
    changed snapshot in any store gets a new identity.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    parts = []
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            parts.append(f"{p}:absent")
            continue
        files = fs.listFiles(path, True)
        while files.hasNext():
            f = files.next()
            parts.append(f"{f.getPath().toString()}:{f.getLen()}:{f.getModificationTime()}")
    return hashlib.sha1("|".join(sorted(parts)).encode()).hexdigest()[:16]


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]):
    """``conf`` holds inside the block."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def table(spark: SparkSession, name: str, signature: str, build: Callable[[], DataFrame],
          partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), arranged: bool = False) -> DataFrame:
    """Return the materialised table ``name`` for ``signature``, building it once per application.

    ``sort_by`` orders rows within each file, so that filters on those columns
    skip row groups.  ``arranged``: the rows that ``build`` gives lie together
    by ``partition_by`` already; they are written as they come."""
    key = (spark.sparkContext.applicationId, f"{name}:{signature}")
    with _LOCK:
        hit = _TABLES.get(key)
        if hit is None:
            base = ensure_checkpoint_dir(spark).rstrip("/")
            path = f"{base}/clickmart-tables/{name}-{signature}-{uuid.uuid4().hex[:8]}"
            df = build()
            out = df
            if partition_by and not arranged:
                # One file set per partition value at small scale; at large scale AQE
                # splits a partition value that holds too much data (rebalance).
                out = df.hint("rebalance", *partition_by)
            if sort_by:
                out = out.sortWithinPartitions(*partition_by, *sort_by)
            writer = out.write.mode("overwrite")
            if partition_by:
                writer = writer.partitionBy(*partition_by)
            with _settings(spark, ARRANGED_CONF if arranged else {}):
                writer.parquet(path)
            # The written schema is given back explicitly: partition values keep
            # their string type ('20240101' is a date label, not a number).  The
            # read is kept, so the file listing happens once per table.
            hit = (path, spark.read.schema(df.schema).parquet(path).select(*df.columns))
            _TABLES[key] = hit
    return hit[1]


def drop_tables(spark: SparkSession) -> None:
    """Delete this application's written tables; DataFrames that read them must not be used afterwards."""
    app = spark.sparkContext.applicationId
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    with _LOCK:
        for k in [k for k in _TABLES if k[0] == app]:
            path = jvm.org.apache.hadoop.fs.Path(_TABLES.pop(k)[0])
            path.getFileSystem(conf).delete(path, True)
