"""Reliable materialisation: write a table to the cluster's shared folder and read it back.

Used where a later step must see exactly the rows, and the row positions, of an earlier one. A written table survives
the loss of executors, keeps column pruning, and cuts the lineage.

Operators that write say so in their docstrings by calling ``stage``; what they write belongs to the ``scope`` they are
called in and is deleted when that ends, so results must be written (or collected) inside it. Without a scope the tables
stay until ``release``.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local_dir: str | None = None
_scope: ContextVar[str | None] = ContextVar("scope", default=None)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    A session on one machine that names none gets a folder of its own, deleted when the program ends.
    """
    global _local_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and every executor can reach")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="churnspark-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return _local_dir


def _session_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/churnspark/{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, name: str) -> str:
    inside = _scope.get()
    return f"{_session_dir(spark)}{'/' + inside if inside else ''}/{uuid.uuid4().hex}/{name}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and return the written table.

    Spark knows the size of a written table, so a join with it is broadcast below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffled above it.
    """
    path = stage_path(df.sparkSession, name)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """What is staged inside belongs to the block and is deleted at its end."""
    token = _scope.set(f"scope-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        folder = f"{_session_dir(spark)}/{_scope.get()}"
        _scope.reset(token)
        _delete(spark, folder)


def release(spark: SparkSession) -> None:
    """Delete all that this application staged. Call it when the results are written."""
    _delete(spark, _session_dir(spark))
