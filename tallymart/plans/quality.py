"""Warehouse validation and the ETL audit, as counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import unpivot_counts
from ..rules import DEFAULT_RULES, Rules
from ..schemas import DOMAIN, FOREIGN_KEYS, NOT_NULL, UNIQUE
from ..sources.raw import RawTables
from ..sources.star import Star
from .star import (
    complete,
    customer_profile,
    order_headers,
    priced,
    translated_products,
    unique_items,
)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _total(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias(name))


# -- warehouse ---------------------------------------------------------------


def row_counts(star: Star) -> DataFrame:
    return _union(
        [
            _total(df, "row_count").select(F.lit(name).alias("table_name"), "row_count")
            for name, df in star.tables().items()
        ]
    )


def orphan_counts(star: Star) -> DataFrame:
    """Fact rows per foreign key whose key, null included, is missing in the dimension.

    The fact is counted per key before the anti join, so the join sees each key
    once, however many rows carry it.
    """
    parts = []
    for column, table, key in FOREIGN_KEYS:
        per_key = star.fact_orders.groupBy(F.col(column).alias(key)).agg(F.count("*").alias("n"))
        missing = per_key.join(getattr(star, table).select(key), key, "left_anti")
        parts.append(
            missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans")).select(
                F.lit(column).alias("foreign_key"), F.lit(table).alias("table_name"), "orphans"
            )
        )
    return _union(parts)


def null_counts(star: Star) -> DataFrame:
    """Nulls per mandatory column, one pass per table."""
    return _union(
        [
            unpivot_counts(
                getattr(star, table).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]),
                "column_name",
                "null_rows",
            ).withColumn("table_name", F.lit(table))
            for table, columns in NOT_NULL.items()
        ]
    ).select("table_name", "column_name", "null_rows")


def duplicate_keys(star: Star, unique: list[tuple[str, list[str]]] = UNIQUE) -> DataFrame:
    """Per unique key: key values that occur more than once, and the rows beyond the first."""
    parts = []
    for table, keys in unique:
        repeated = (
            getattr(star, table).groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)
        )
        parts.append(
            repeated.agg(
                F.count("*").alias("duplicate_keys"),
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"),
            ).select(
                F.lit(table).alias("table_name"),
                F.lit(", ".join(keys)).alias("key_columns"),
                "duplicate_keys",
                "extra_rows",
            )
        )
    return _union(parts)


def domain_violations(star: Star) -> DataFrame:
    """Rows whose value is outside the column's list; null passes."""
    return _union(
        [
            getattr(star, table)
            .agg(F.count_if(~F.col(column).isin(allowed)).alias("bad_rows"))
            .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "bad_rows")
            for table, column, allowed in DOMAIN
        ]
    )


def _counters(star: Star, table: str) -> DataFrame:
    """Rows, nulls and domain violations of a table in one pass, as report rows."""
    counted = [value.alias(name) for name, value in counter_columns(table).items()]
    return report_rows(getattr(star, table).agg(*counted))


def counter_columns(table: str) -> dict[str, Column]:
    """What a pass over the table counts, by check/table/subject."""
    counters = {f"row_count/{table}/*": F.count("*")}
    for column in NOT_NULL[table]:
        counters[f"nulls/{table}/{column}"] = F.count_if(F.col(column).isNull())
    for owner, column, allowed in DOMAIN:
        if owner == table:
            counters[f"domain/{table}/{column}"] = F.count_if(~F.col(column).isin(allowed))
    return counters


def validation_report(star: Star) -> DataFrame:
    """All checks in one shape: what was checked, on what, and how many.

    The fact is read three times: for the counters, which need no shuffle, for its keys
    alone, and once per order.
    """
    return _union([*(_counters(star, table) for table in NOT_NULL), key_report(star)])


def key_report(star: Star) -> DataFrame:
    """The part of the report that compares rows: repeated keys, orphans, mixed orders."""
    duplicates = duplicate_keys(star, [u for u in UNIQUE if u[0] != "fact_orders"]).select(
        F.lit("duplicates").alias("check_name"),
        "table_name",
        F.col("key_columns").alias("subject"),
        F.col("extra_rows").alias("n"),
    )
    return _union([duplicates, _fact_by_key(star), _fact_by_order(star)])


def _fact_by_key(star: Star) -> DataFrame:
    """The fact's orphans in one pass over its key columns: each row stands under every key."""
    keys = F.array(
        *(
            F.struct(F.lit(i).alias("fk"), F.col(column).cast("bigint").alias("key"))
            for i, (column, _, _) in enumerate(FOREIGN_KEYS)
        )
    )
    stood = star.fact_orders.select(F.inline(keys))
    per_key = stood.groupBy("fk", "key").agg(F.count("*").alias("rows"))
    known = _union(
        [
            getattr(star, table).select(F.lit(i).alias("fk"), F.col(key).cast("bigint").alias("key"))
            for i, (_, table, key) in enumerate(FOREIGN_KEYS)
        ]
    )
    # A repeated dimension key does not repeat rows here, and a null key finds none.
    missing = per_key.join(known, ["fk", "key"], "left_anti")
    return report_rows(
        missing.agg(
            *(
                F.coalesce(F.sum(F.when(F.col("fk") == i, F.col("rows"))), F.lit(0)).alias(f"orphans/{table}/{column}")
                for i, (column, table, _) in enumerate(FOREIGN_KEYS)
            )
        )
    )


def _fact_by_order(star: Star) -> DataFrame:
    """Repeated (order, product) pairs, and orders that disagree on what an order has one of."""
    ((_, pair),) = [u for u in UNIQUE if u[0] == "fact_orders"]
    head = F.xxhash64("order_date_key", "customer_key", "payment_status", "channel")
    pairs = star.fact_orders.groupBy(*pair).agg(
        F.count("*").alias("n"), F.min(head).alias("low"), F.max(head).alias("high")
    )
    orders = pairs.groupBy("order_id").agg(
        F.sum(F.col("n") - 1).alias("extra"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    return report_rows(
        orders.agg(
            F.coalesce(F.sum("extra"), F.lit(0)).alias(f"duplicates/fact_orders/{', '.join(pair)}"),
            F.count_if(F.col("low") != F.col("high")).alias("mixed_orders/fact_orders/order_id"),
        )
    )


def report_rows(counts: DataFrame) -> DataFrame:
    """One row of counters named check/table/subject as report rows."""
    name = F.split("name", "/")
    return unpivot_counts(counts, "name", "n").select(
        name[0].alias("check_name"), name[1].alias("table_name"), name[2].alias("subject"), "n"
    )


# -- ETL ---------------------------------------------------------------------


def etl_audit(raw: RawTables, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Rows read, dropped and kept, per stage."""
    read = [
        unpivot_counts(_total(df, f"read_{name}"), "stage", "n_rows")
        for name, df in raw._asdict().items()
    ]
    usable = complete("order_date", "customer_id", "product_id")
    steps = (
        priced(unique_items(raw), rules)
        .join(order_headers(raw), "order_id", "left")
        .agg(
            F.count("*").alias("items_unique"),
            F.count_if(~usable).alias("items_incomplete"),
            F.count_if(usable & (F.col("revenue") > 0)).alias("fact_orders"),
        )
    )
    repeated = raw.order_items.agg(F.count("*").alias("n")).scalar() - F.col("items_unique")
    steps = steps.withColumn("items_repeated", repeated)
    sizes = [
        _total(customer_profile(raw, rules).select("customer_id"), "dim_customer"),
        _total(translated_products(raw).select("product_id"), "dim_product"),
        raw.orders.agg(
            F.countDistinct(F.to_date("order_purchase_timestamp")).alias("dim_date")
        ),
    ]
    return _union([*read, *[unpivot_counts(df, "stage", "n_rows") for df in [steps, *sizes]]])


def dimension_profile(star: Star) -> DataFrame:
    """Customers per segment, distinct categories, first and last day."""
    segments = star.dim_customer.groupBy("segment").agg(F.count("*").alias("n"))
    days = star.dim_date.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    return _union(
        [
            segments.select(
                F.concat(F.lit("customers_"), "segment").alias("metric"),
                F.col("n").cast("string").alias("value"),
            ),
            star.dim_product.agg(F.countDistinct("category").alias("n")).select(
                F.lit("categories").alias("metric"), F.col("n").cast("string").alias("value")
            ),
            days.select(
                F.col("first").cast("string").alias("first_date"),
                F.col("last").cast("string").alias("last_date"),
            ).unpivot([], ["first_date", "last_date"], "metric", "value"),
        ]
    )
