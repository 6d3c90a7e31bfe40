"""Intermediate tables in the folder all executors share.

Spark names that folder in ``spark.checkpoint.dir``.  A table written there
cuts the lineage and survives the loss of executors.  All tables of one
application lie below one folder, which ``remove_shared`` deletes.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_lock = threading.Lock()


def _application_dir(spark: SparkSession) -> str:
    app = spark.conf.get("spark.app.id", "app")
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", None) or ""
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        # One machine is the whole cluster here, as in tests.
        with _lock:
            if app not in _local_roots:
                _local_roots[app] = tempfile.mkdtemp(prefix="tallymart-")
            root = _local_roots[app]
    return f"{root.rstrip('/')}/tallymart/{app}"


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the application's part of the shared folder."""
    return f"{_application_dir(spark)}/{label}-{uuid.uuid4().hex}"


def remove_shared(spark: SparkSession) -> None:
    """Delete the application's intermediate tables; frames that read them end with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_application_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, partition for partition."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` if ``store`` wrote it, else a stored copy, for frames that are read more than once."""
    return df if hasattr(df, "_stored_at") else store(df, label)


def forget(df: DataFrame) -> None:
    """Delete a table that ``store`` wrote, once nothing reads it any more; others are left alone."""
    path = getattr(df, "_stored_at", None)
    if path is not None:
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def together(spark: SparkSession, *jobs: Callable) -> list:
    """Run independent jobs side by side; a later one uses cores an earlier one leaves idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
        return [job.result() for job in started]
