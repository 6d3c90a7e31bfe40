"""The six raw tables and how to read them."""

from __future__ import annotations

from functools import partial, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW, conform
from .shared import shared_dir, together


class RawTables(NamedTuple):
    """Raw inputs.  ``order_items`` may carry a ``cost_ratio`` column; without one the
    ratio of the rules applies to every item."""

    orders: DataFrame
    order_items: DataFrame
    customers: DataFrame
    products: DataFrame
    payments: DataFrame
    category_translation: DataFrame


# File names of the public marketplace data set.
RAW_FILES = {
    "orders": "olist_orders_dataset.csv",
    "order_items": "olist_order_items_dataset.csv",
    "customers": "olist_customers_dataset.csv",
    "products": "olist_products_dataset.csv",
    "payments": "olist_order_payments_dataset.csv",
    "category_translation": "product_category_name_translation.csv",
}


_CORRUPT = "_corrupt_record"


class Staged(NamedTuple):
    """Raw tables in the shared folder, what was left out of them, and the rows of both."""

    raw: RawTables
    #: table_name, file, reason, record
    rejects: DataFrame
    read: dict[str, int]
    rejected: dict[str, int]


def _csv(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    """CSV with a header; a quote inside a quoted field is doubled.

    With ``multi_line`` a quoted field may go over lines; such a file is read by one task.
    """
    return (
        spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    )


def read_raw_csv(
    spark: SparkSession, directory: str, files: dict[str, str] = RAW_FILES, multi_line: bool = False
) -> RawTables:
    """Read CSV files with a header; columns are taken by name and cast, never inferred."""
    return RawTables(
        **{
            name: conform(_csv(spark, multi_line).csv(f"{directory}/{file}"), RAW[name])
            for name, file in files.items()
        }
    )


def _checked(rows: DataFrame, schema: T.StructType) -> tuple[list[Column], Column, Column]:
    """Typed columns, why a row cannot be taken (null if it can), and the row as text."""
    typed, reasons = [], [F.when(F.col(_CORRUPT).isNotNull(), F.lit("number of fields"))]
    for field in schema.fields:
        found = F.col(f"`{field.name}`")
        value = found.try_cast(field.dataType)
        typed.append(value.alias(field.name))
        kind = field.dataType.simpleString()
        bad = found.isNotNull() & value.isNull()
        reasons.append(F.when(bad, F.lit(f"{field.name} is no {kind}")))
    fields = F.struct(*(F.col(f"`{c}`") for c in rows.columns if c != _CORRUPT))
    return typed, F.coalesce(*reasons), F.coalesce(F.col(_CORRUPT), F.to_csv(fields))


def stage_raw_csv(
    spark: SparkSession, directory: str, files: dict[str, str] = RAW_FILES, multi_line: bool = False
) -> Staged:
    """Read each CSV file once; rows that do not fit the types are set aside, not lost.

    A row is rejected if it has more or fewer fields than the header, or a field that
    is not of its column's type; the first reason counts.  Good and rejected rows are
    written to the shared folder in one job per file, apart by a partition column, and
    counted while they are written.
    """

    def stage(name: str, file: str) -> tuple[DataFrame, DataFrame, dict]:
        path = f"{directory}/{file}"
        header = _csv(spark, multi_line).csv(path).columns
        text = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _CORRUPT]])
        rows = (
            _csv(spark, multi_line).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _CORRUPT).schema(text).csv(path)
        )
        typed, reason, record = _checked(rows, RAW[name])
        seen = Observation(f"raw-{name}")
        target = shared_dir(spark, f"raw-{name}")
        marked = rows.select(
            *typed, reason.alias("reason"), F.col("_metadata.file_path").alias("file"), record.alias("record")
        )
        bad = F.col("reason").isNotNull()
        staged = marked.select(
            *RAW[name].names, "reason", *(F.when(bad, F.col(c)).alias(c) for c in ("file", "record")),
            bad.alias("rejected"),
        ).observe(seen, F.count_if(~F.col("rejected")).alias("read"), F.count_if("rejected").alias("rejected"))
        staged.write.partitionBy("rejected").parquet(target)
        back = spark.read.schema(staged.schema).parquet(target)
        rejects = back.where("rejected").select(
            F.lit(name).alias("table_name"), "file", "reason", "record"
        )
        return back.where("NOT rejected").select(*RAW[name].names), rejects, seen.get

    done = together(spark, *(partial(stage, name, file) for name, file in files.items()))
    return Staged(
        RawTables(**{name: good for name, (good, _, _) in zip(files, done, strict=True)}),
        reduce(DataFrame.unionByName, (rejects for _, rejects, _ in done)),
        {name: seen["read"] for name, (_, _, seen) in zip(files, done, strict=True)},
        {name: seen["rejected"] for name, (_, _, seen) in zip(files, done, strict=True)},
    )


def stage_raw(raw: RawTables) -> Staged:
    """Raw tables written to the shared folder, each read once and counted on the way."""
    spark = raw.orders.sparkSession

    def stage(name: str, df: DataFrame) -> tuple[DataFrame, int]:
        seen, target = Observation(f"raw-{name}"), shared_dir(spark, f"raw-{name}")
        df.observe(seen, F.count(F.lit(1)).alias("read")).write.parquet(target)
        return spark.read.schema(df.schema).parquet(target), seen.get["read"]

    done = dict(
        zip(raw._fields, together(spark, *(partial(stage, n, df) for n, df in raw._asdict().items())), strict=True)
    )
    none = spark.createDataFrame([], "table_name string, file string, reason string, record string")
    return Staged(
        RawTables(**{name: df for name, (df, _) in done.items()}), none,
        {name: n for name, (_, n) in done.items()}, dict.fromkeys(done, 0),
    )


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Rejected rows per table and reason."""
    return rejects.groupBy("table_name", "reason").agg(F.count("*").alias("n_rows"))


def read_raw_parquet(spark: SparkSession, directory: str) -> RawTables:
    """Read ``<directory>/<table>.parquet`` for each raw table."""
    return RawTables(
        **{
            name: conform(spark.read.parquet(f"{directory}/{name}.parquet"), schema)
            for name, schema in RAW.items()
        }
    )


def register_raw(raw: RawTables) -> None:
    """Temp views ``raw_<table>`` for ad-hoc SQL."""
    for name, df in raw._asdict().items():
        df.createOrReplaceTempView(f"raw_{name}")
