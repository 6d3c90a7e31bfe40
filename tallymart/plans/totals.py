"""Pre-aggregations the reports share.

Reports group by attributes of a product, a customer or an order.  Each first
sums the fact per product or customer key, inside the map tasks, so a key that
holds a large part of the rows shrinks to one partial row per task before
anything is shuffled; only then the dimension is joined.  An order has one
date, customer, status and channel (the fact build sees to that), so distinct
orders may be counted per customer or day and added up.

``with_summaries`` writes these sums once, for jobs that compute many reports:
two passes over the fact instead of one or more per report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import percent
from ..functions.mapping import FAILED, SUCCESS
from ..sources.shared import store, together
from ..sources.star import Star, Summaries


def is_paid() -> Column:
    return F.col("payment_status") == SUCCESS


def is_failed() -> Column:
    return F.col("payment_status") == FAILED


def margin() -> Column:
    """Profit as a percentage of revenue."""
    return percent(F.col("profit"), F.col("revenue"))


def paid_items(star: Star) -> DataFrame:
    return star.fact_orders.where(is_paid())


def dated(df: DataFrame, star: Star) -> DataFrame:
    """Join the date dimension, which has at most one row per calendar day."""
    return df.join(F.broadcast(star.dim_date), df["order_date_key"] == star.dim_date["date_key"])


def _added(name: str) -> Column:
    """Sum of a count, zero without rows."""
    return F.coalesce(F.sum(name), F.lit(0))


def _sums() -> list[Column]:
    return [
        F.count("*").alias("items"),
        F.sum("revenue").alias("revenue"),
        F.sum("profit").alias("profit"),
    ]


# -- per day, channel and status ---------------------------------------------


def daily_totals(star: Star) -> DataFrame:
    """Distinct orders, items, revenue and profit per day, channel and payment status."""
    if star.summaries:
        return star.summaries.daily
    return star.fact_orders.groupBy("order_date_key", "channel", "payment_status").agg(
        F.countDistinct("order_id").alias("orders"), *_sums()
    )


def _activity(star: Star) -> DataFrame:
    """The daily sums where they exist, else the fact with each row as one item."""
    if star.summaries:
        return star.summaries.daily
    return star.fact_orders.withColumn("items", F.lit(1).cast("bigint"))


def overall_totals(star: Star) -> DataFrame:
    """One row: items, and the items, revenue and profit that were paid."""
    return _activity(star).agg(
        _added("items").alias("items"),
        F.coalesce(F.sum(F.when(is_paid(), F.col("items"))), F.lit(0)).alias("paid_items"),
        F.sum(F.when(is_paid(), F.col("revenue"))).alias("revenue"),
        F.sum(F.when(is_paid(), F.col("profit"))).alias("profit"),
    )


def channel_totals(star: Star) -> DataFrame:
    """Items, paid and failed items, and their revenue, per channel."""
    return _by_channel(_activity(star))


def monthly_channel_totals(star: Star) -> DataFrame:
    return _by_channel(dated(_activity(star), star), "year", "month")


def _by_channel(activity: DataFrame, *by: str) -> DataFrame:
    return activity.groupBy(*by, "channel").agg(
        _added("items").alias("items"),
        _where(is_paid(), "items").alias("paid_items"),
        _where(is_failed(), "items").alias("failed_items"),
        F.sum("revenue").alias("revenue"),
        _where(is_paid(), "revenue").alias("paid_revenue"),
        _where(is_failed(), "revenue").alias("failed_revenue"),
    )


def _where(condition: Column, name: str) -> Column:
    return F.sum(F.when(condition, F.col(name)).otherwise(0))


def monthly_totals(star: Star) -> DataFrame:
    """Paid distinct orders, revenue and profit per month."""
    if star.summaries:
        paid, orders = star.summaries.daily.where(is_paid()), F.sum("orders")
    else:
        paid, orders = paid_items(star), F.countDistinct("order_id")
    return (
        dated(paid, star)
        .groupBy("year", "month")
        .agg(
            orders.alias("orders"),
            F.sum("revenue").alias("revenue"),
            F.sum("profit").alias("profit"),
        )
    )


# -- per product -------------------------------------------------------------


def product_sums(star: Star) -> DataFrame:
    """Paid items, revenue and profit per product key."""
    if star.summaries:
        return star.summaries.products
    return paid_items(star).groupBy("product_key").agg(*_sums())


def product_totals(star: Star) -> DataFrame:
    """Product sums with product id and category."""
    named = star.dim_product.select("product_key", "product_id", "category")
    return product_sums(star).join(named, "product_key")


def category_totals(star: Star) -> DataFrame:
    """Paid products, items, revenue and profit per category."""
    return (
        product_totals(star)
        .groupBy("category")
        .agg(
            F.count("*").alias("products"),
            F.sum("items").alias("items"),
            F.sum("revenue").alias("revenue"),
            F.sum("profit").alias("profit"),
        )
    )


def category_orders(star: Star) -> DataFrame:
    """Paid distinct orders, items, revenue and profit per category.

    A category's orders can only be told apart at item grain, so this one joins
    the product dimension to the fact itself.
    """
    categories = star.dim_product.select("product_key", "category")
    return (
        paid_items(star)
        .join(categories, "product_key")
        .groupBy("category")
        .agg(F.countDistinct("order_id").alias("orders"), *_sums())
    )


def category_and_total_orders(star: Star) -> DataFrame:
    """Paid distinct orders and revenue per category, and in a row with ``_total`` 1 of all.

    The category of an unknown product is null.
    """
    categories = star.dim_product.select("product_key", "category")
    return (
        paid_items(star)
        .join(categories, "product_key", "left")
        .rollup("category")
        .agg(
            F.grouping("category").alias("_total"),
            F.countDistinct("order_id").alias("orders"),
            F.sum("revenue").alias("revenue"),
        )
    )


# -- per customer ------------------------------------------------------------


def customer_totals(star: Star) -> DataFrame:
    """Paid distinct orders, items, revenue and profit per customer key."""
    if star.summaries:
        return star.summaries.customers
    return (
        paid_items(star)
        .groupBy("customer_key")
        .agg(F.countDistinct("order_id").alias("orders"), *_sums())
    )


def customer_sums(star: Star) -> DataFrame:
    """Paid items, revenue and profit per customer key, without counting orders."""
    if star.summaries:
        return star.summaries.customers
    return paid_items(star).groupBy("customer_key").agg(*_sums())


def one_time_customers(star: Star) -> DataFrame:
    """Customers with a paid item, and whether all of theirs are of one order.

    The smallest and the largest order id tell, so one row per customer is
    shuffled and not one per order.
    """
    if star.summaries:
        return star.summaries.customers.select(
            "customer_key", (F.col("orders") == 1).alias("one_time")
        )
    single = F.min("order_id") == F.max("order_id")
    return paid_items(star).groupBy("customer_key").agg(single.alias("one_time"))


#: Rows of a report's list up to which it is broadcast: a few hundred bytes each.
LISTED_ROWS = 10_000


def orders_of(star: Star, chosen: DataFrame, key: str, most: int) -> DataFrame:
    """Add the distinct paid orders to a report's chosen products or customers.

    For reports that rank by something else and list a few rows: ranking first
    and counting only for what is listed spares shuffling every order.  ``most``
    is the limit that bounds ``chosen``: a short list is broadcast, the join with
    a longer one is left to Spark, which measures it.
    """
    if "orders" in chosen.columns:
        return chosen.withColumnRenamed("orders", "order_count")
    return (
        paid_items(star)
        .select(key, "order_id")
        .join(F.broadcast(chosen) if most <= LISTED_ROWS else chosen, key)
        .groupBy(*chosen.columns)
        .agg(F.countDistinct("order_id").alias("order_count"))
    )


# -- stored ------------------------------------------------------------------


def with_summaries(star: Star) -> Star:
    """The star with its sums written to the shared folder.

    The fact is read twice: summed per order, from which the sums per day and per
    customer follow, and summed per product.
    """
    base = star._replace(summaries=None)
    spark = star.fact_orders.sparkSession
    orders, products = together(
        spark,
        lambda: store(_order_sums(base), "orders"),
        lambda: store(product_sums(base), "products"),
    )
    added = [F.count("*").alias("orders"), *(F.sum(c).alias(c) for c in ("items", "revenue", "profit"))]
    daily, customers = together(
        spark,
        lambda: store(orders.groupBy("order_date_key", "channel", "payment_status").agg(*added), "daily"),
        lambda: store(orders.where(is_paid()).groupBy("customer_key").agg(*added), "customers"),
    )
    return star._replace(summaries=Summaries(daily, customers, products))


def _order_sums(star: Star) -> DataFrame:
    """A row per order, with what it has one of; the validation report checks that it has."""
    return star.fact_orders.groupBy(
        "order_id", "customer_key", "order_date_key", "channel", "payment_status"
    ).agg(*_sums())
