"""Clean zone to warehouse: surrogate keys into the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.star import Star
from .star import FACT_MEASURES, complete, date_key

_KEYS = ["order_date_key", "customer_key", "product_key"]


def map_keys(clean: Star) -> DataFrame:
    """Fact with keys instead of ids, unmatched rows still in, their keys null.

    The dimensions are joined without a broadcast hint: Spark broadcasts one
    whose measured size is under its threshold, otherwise it sort-merge joins
    and splits skewed ids at run time.
    """
    customers = clean.dim_customer.select("customer_id", "customer_key")
    products = clean.dim_product.select("product_id", "product_key")
    return (
        clean.fact_orders.withColumn("order_date_key", date_key(F.col("order_date")))
        .join(customers, "customer_id", "left")
        .join(products, "product_id", "left")
        .select("order_id", *_KEYS, *FACT_MEASURES)
    )


def load_fact(clean: Star) -> DataFrame:
    """Fact rows with all keys found; the others are dropped."""
    return map_keys(clean).where(complete(*_KEYS))


def load_star(clean: Star) -> Star:
    return clean._replace(fact_orders=load_fact(clean))
