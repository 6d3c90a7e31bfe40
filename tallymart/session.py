"""Sessions: what the jobs expect of one, and a local one for tests."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings the plans count on, on a cluster as well as here.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Fewer, larger tasks and files than the default of 64 MB.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Whole texts go to Python workers: bound a batch in bytes, not only in rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "33554432",
    # Plans are built from many small column calls; do not record a call site for each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def session(app: str) -> SparkSession:
    """The session of a submitted job; master and sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(app: str, cpus: int | None = None) -> SparkSession:
    cpus = cpus or os.cpu_count()
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
