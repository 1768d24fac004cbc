"""Session settings the library relies on."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def wall_clock_utc(spark: SparkSession):
    """Pin what results depend on while a query is put together: its expressions keep UTC as their time zone, and the
    session gets its own back."""
    return settings(spark, spark__sql__session__timeZone="UTC")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name below the one the cluster names in ``spark.checkpoint.dir``.

    Only on a local master a temporary folder takes its place where that setting is missing; on a cluster no such
    folder is seen by all, so its absence is an error.
    """
    return f"{checkpoint_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def removed_at_end(spark: SparkSession, *folders: str) -> None:
    """Have folders that exist by now deleted when the application ends."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)


def checkpoint_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="tidemark-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


@contextmanager
def settings(spark: SparkSession, **values):
    """Set SQL options (dots written as ``__``) for a block, then put the old values back."""
    names = {name.replace("__", "."): value for name, value in values.items() if value is not None}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
