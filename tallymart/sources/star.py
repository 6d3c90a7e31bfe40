"""Star schema tables: the tuple, clean zone and warehouse readers and writers."""

from __future__ import annotations

import time
import uuid
from functools import partial
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import CLEAN, WAREHOUSE, conform
from .shared import together


class Summaries(NamedTuple):
    """Sums of the fact the reports can start from instead of the fact itself."""

    daily: DataFrame  # per day, channel and payment status
    customers: DataFrame  # paid, per customer key
    products: DataFrame  # paid, per product key


class Star(NamedTuple):
    fact_orders: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    summaries: Summaries | None = None

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLES}


_CURRENT, _VERSION = "CURRENT", "version-"
TABLES = ("fact_orders", "dim_customer", "dim_product", "dim_date")


def write_clean(star: Star, directory: str, fmt: str = "parquet") -> None:
    """Replace the clean zone, one folder per table, as Parquet or CSV with a header."""

    def write(name: str, df: DataFrame) -> None:
        writer = df.write.mode("overwrite").format(fmt)
        if fmt == "csv":  # a quote inside a quoted field is doubled
            writer = writer.option("header", True).option("escape", '"')
        writer.save(f"{directory}/{name}")

    jobs = [partial(write, name, df) for name, df in star.tables().items()]
    together(star.fact_orders.sparkSession, *jobs)


def read_clean(
    spark: SparkSession, directory: str, fmt: str = "parquet", multi_line: bool = False
) -> Star:
    """``multi_line`` is for CSV with line breaks inside fields; a file is then read by one task."""
    return Star(**{name: _read(spark, directory, name, fmt, CLEAN, multi_line) for name in TABLES})


def write_fact(fact: DataFrame, directory: str) -> None:
    """Replace the fact table, partitioned by month.

    Rebalancing lets adaptive execution cut a month that holds much of the data
    into several files and pack small months together; without it every task
    would write a file for every month.
    """
    (
        fact.withColumn("order_month", F.expr("order_date_key div 100").cast("int"))
        .hint("rebalance", "order_month")
        .write.mode("overwrite")
        .partitionBy("order_month")
        .parquet(f"{directory}/fact_orders")
    )


def write_dimension(star: Star, name: str, directory: str) -> None:
    getattr(star, name).write.mode("overwrite").parquet(f"{directory}/{name}")


def write_version(star: Star, directory: str) -> str:
    """Write the tables to a version folder of their own, which no reader looks at yet."""
    version = f"{_VERSION}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    target = f"{directory}/{version}"
    together(
        star.fact_orders.sparkSession,
        lambda: write_fact(star.fact_orders, target),
        *[partial(write_dimension, star, name, target) for name in TABLES[1:]],
    )
    return version


def publish_version(spark: SparkSession, directory: str, version: str, keep: int = 2) -> None:
    """Let readers see a written version; the newest ``keep`` stay, for readers that have begun."""
    _switch(spark, directory, version)
    _drop_old(spark, directory, keep)


def drop_version(spark: SparkSession, directory: str, version: str) -> None:
    path, _, conf = _paths(spark, directory)
    path(directory).getFileSystem(conf).delete(path(f"{directory}/{version}"), True)


def write_warehouse(star: Star, directory: str, keep: int = 2) -> None:
    """Replace the warehouse as a whole.

    The tables are written to a folder of their own; the file CURRENT, which names
    that folder, is switched last.  A job that fails leaves the old star in place,
    and a reader never sees keys of one build beside dimensions of another.
    ``plans.publish`` does the same behind the declared constraints.
    """
    version = write_version(star, directory)
    publish_version(star.fact_orders.sparkSession, directory, version, keep)


def read_version(spark: SparkSession, directory: str, version: str) -> Star:
    folder = f"{directory}/{version}"
    return Star(**{name: _read(spark, folder, name, "parquet", WAREHOUSE) for name in TABLES})


def read_warehouse(spark: SparkSession, directory: str) -> Star:
    """The star of the version that CURRENT names now."""
    return read_version(spark, directory, spark.read.text(f"{directory}/{_CURRENT}").first()[0])


def _paths(spark: SparkSession, directory: str):
    """Hadoop's Path class, the folder's file context, and Spark's configuration."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    return path, jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(directory).toUri(), conf), conf


def _switch(spark: SparkSession, directory: str, version: str) -> None:
    """Put a new CURRENT in the place of the old one, by a rename."""
    path, context, conf = _paths(spark, directory)
    fresh = path(f"{directory}/.{_CURRENT}-{version}")
    out = fresh.getFileSystem(conf).create(fresh, True)
    out.write(bytearray(f"{version}\n".encode()))
    out.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(fresh, path(f"{directory}/{_CURRENT}"), options)


def _drop_old(spark: SparkSession, directory: str, keep: int) -> None:
    path, _, conf = _paths(spark, directory)
    files = path(directory).getFileSystem(conf)
    names = [s.getPath().getName() for s in files.listStatus(path(directory))]
    for name in sorted(n for n in names if n.startswith(_VERSION))[:-keep]:
        files.delete(path(f"{directory}/{name}"), True)


def register_views(star: Star) -> None:
    """Temp views named like the tables, for ``spark.sql``."""
    for name, df in star.tables().items():
        df.createOrReplaceTempView(name)


def _read(
    spark: SparkSession, directory: str, name: str, fmt: str, schemas: dict, multi_line: bool = False
) -> DataFrame:
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", multi_line)
    return conform(reader.load(f"{directory}/{name}"), schemas[name], keep_ids=fmt != "csv")
