"""Shared folder for written intermediate tables, and column-name helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


_SHIPPED: set[str] = set()
#: (application id, path) of the tables written.
_WRITTEN: set[tuple[str, str]] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the executors' Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="clickmart-code-"), "clickmart_code.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local-master session (tests) may go without it and gets a scratch
    folder of its own; on a cluster a missing setting is an error, since a
    machine-local folder would hold only one executor's part.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="clickmart-llm-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    This cuts the lineage: later jobs, and retries after a lost executor,
    read the files instead of repeating the work, and all see the same rows.
    """
    path = f"{shared_dir(df.sparkSession)}/llm-tables/{name}-{uuid.uuid4().hex}"
    _WRITTEN.add((df.sparkSession.sparkContext.applicationId, path))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_tables(spark: SparkSession) -> None:
    """Delete this application's written tables; DataFrames that read them must not be used afterwards."""
    app = spark.sparkContext.applicationId
    for written in [w for w in _WRITTEN if w[0] == app]:
        path = spark._jvm.org.apache.hadoop.fs.Path(written[1])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        _WRITTEN.discard(written)


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` minus the columns whose names an operator is about to add."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])
