"""The two test stars, built once per application and input directory."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallymart.plans.star import build_star
from tallymart.sources.driver_tables import copied_raw, graded_raw, plain_raw
from tallymart.sources.raw import RawTables
from tallymart.sources.shared import shared_dir
from tallymart.sources.star import Star, read_warehouse, write_warehouse

RAW = {"plain": plain_raw, "copied": copied_raw, "graded": graded_raw}
_built: dict[tuple[str, str, str], Star] = {}


def raw(spark: SparkSession, sf_dir: str, name: str) -> RawTables:
    return RAW[name](spark, sf_dir)


def star(spark: SparkSession, sf_dir: str, name: str) -> Star:
    """The star as warehouse tables in the shared folder, written on first use."""
    key = (spark.conf.get("spark.app.id"), sf_dir, name)
    if key not in _built:
        directory = shared_dir(spark, f"warehouse-{name}")
        write_warehouse(build_star(raw(spark, sf_dir, name)), directory)
        _built[key] = read_warehouse(spark, directory)
    return _built[key]
