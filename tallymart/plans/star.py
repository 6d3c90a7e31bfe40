"""Raw tables to star schema.

Shape of the fact build: everything that is known per order (date, status,
channel, customer key) is joined at order grain first.  The item table, the big
side, is shuffled for its deduplication, for the join with the order header and,
where dim_product is too large to broadcast, for the join with it.  Orders without
a usable date or customer drop out in the join.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import channel_of, money, payment_status_of, ratio, segment_of
from ..functions.mapping import BRAND, UNTRANSLATED
from ..operators import dense_keys, keep_first
from ..rules import DEFAULT_RULES, Rules
from ..schemas import MONEY
from ..sources.raw import RawTables
from ..sources.shared import together
from ..sources.star import Star

FACT_MEASURES = ["quantity", "revenue", "cost", "profit", "payment_status", "channel"]


def date_key(date: Column) -> Column:
    """YYYYMMDD as an int, by arithmetic on the date parts."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("int")


def complete(*columns: str) -> Column:
    """All columns non-null.  Spelled out instead of ``na.drop``, whose count of
    nulls the optimizer cannot use to turn an outer join into an inner one."""
    return reduce(and_, (F.col(c).isNotNull() for c in columns))


# -- order grain -------------------------------------------------------------


def payments_by_order(raw: RawTables) -> DataFrame:
    """First non-null payment type by sequence, and the value paid, per order.

    Shuffled before it is grouped: the least struct is found by sorting, which then
    happens once, behind the shuffle, and not in every input split as well.
    """
    typed = F.when(
        F.col("payment_type").isNotNull(), F.struct("payment_sequential", "payment_type")
    )
    return (
        raw.payments.select("order_id", "payment_sequential", "payment_type", "payment_value")
        .repartition("order_id")
        .groupBy("order_id")
        .agg(F.min(typed).alias("first"), F.sum("payment_value").alias("payment_value"))
        .select("order_id", F.col("first.payment_type").alias("payment_type"), "payment_value")
    )


def unique_orders(raw: RawTables) -> DataFrame:
    """One row per order; a repeated order id keeps its earliest row."""
    orders = raw.orders.select(
        "order_id", "customer_id", "order_purchase_timestamp", "order_status"
    )
    return keep_first(orders, ["order_id"], ["order_purchase_timestamp"])


def order_headers(raw: RawTables) -> DataFrame:
    """What the fact takes over from the order: date, customer, status, channel."""
    paid = payments_by_order(raw).select("order_id", "payment_type")
    return unique_orders(raw).join(paid, "order_id", "left").select(
        "order_id",
        "customer_id",
        F.to_date("order_purchase_timestamp").alias("order_date"),
        payment_status_of(F.col("order_status")).alias("payment_status"),
        channel_of(F.col("payment_type")).alias("channel"),
    )


# -- item grain --------------------------------------------------------------


def unique_items(raw: RawTables) -> DataFrame:
    """One row per order and item number, the first by product and price."""
    wanted = ["order_id", "order_item_id", "product_id", "price", "cost_ratio"]
    items = raw.order_items.select(*[c for c in wanted if c in raw.order_items.columns])
    return keep_first(items, ["order_id", "order_item_id"], ["product_id", "price"])


def items_with_orders(raw: RawTables) -> DataFrame:
    """Every item with its order's columns; items without an order keep nulls."""
    orders = raw.orders.select(
        "order_id", "customer_id", "order_purchase_timestamp", "order_status"
    )
    return raw.order_items.select("order_id", "order_item_id", "product_id", "price").join(
        orders, "order_id", "left"
    )


def priced(items: DataFrame, rules: Rules) -> DataFrame:
    """Add quantity, revenue, cost and profit to items."""
    own_ratio = "cost_ratio" in items.columns
    cost_ratio = F.col("cost_ratio") if own_ratio else F.lit(rules.cost_ratio)
    local = F.col("price").cast(MONEY) * F.lit(rules.currency_rate)
    return (
        items.withColumn("quantity", F.lit(1))
        .withColumn("revenue", money(local))
        .withColumn("cost", money(local * cost_ratio))
        .withColumn("profit", (F.col("revenue") - F.col("cost")).cast(MONEY))
    )


def build_fact(
    raw: RawTables, rules: Rules = DEFAULT_RULES, seen: Observation | None = None
) -> DataFrame:
    """Clean fact at item grain, with natural ids.

    ``seen`` counts the rows by what becomes of them, behind the last shuffle.  The filters
    then stay above the join, so rows that they drop are shuffled as well.
    """
    usable = complete("order_date", "customer_id", "product_id")
    items = (
        priced(unique_items(raw).join(order_headers(raw), "order_id", "left"), rules)
        .select("order_id", "order_date", "customer_id", "product_id", *FACT_MEASURES)
    )
    if seen is not None:
        items = items.observe(
            seen,
            F.count(F.lit(1)).alias("items_unique"),
            F.count_if(~usable).alias("items_incomplete"),
            F.count_if(usable & (F.col("revenue") > 0)).alias("fact_orders"),
        )
    return items.where(usable).where(F.col("revenue") > 0)


# -- dimensions --------------------------------------------------------------


def customer_orders(raw: RawTables) -> DataFrame:
    """Signup date and number of orders per customer, over orders of any status."""
    return raw.orders.groupBy("customer_id").agg(
        F.to_date(F.min("order_purchase_timestamp")).alias("signup_date"),
        F.count("*").alias("order_count"),
    )


def unique_customers(raw: RawTables) -> DataFrame:
    customers = raw.customers.select(
        "customer_id", "customer_unique_id", "customer_city", "customer_state"
    )
    return keep_first(customers, ["customer_id"])


def customer_profile(raw: RawTables, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Customer dimension before its surrogate key."""
    return (
        unique_customers(raw)
        .withColumnRenamed("customer_state", "country")
        .join(customer_orders(raw), "customer_id", "left")
        .select(
            "customer_id",
            "country",
            "signup_date",
            segment_of(F.col("order_count"), rules).alias("segment"),
        )
    )


def build_dim_customer(raw: RawTables, rules: Rules = DEFAULT_RULES) -> DataFrame:
    return dense_keys(customer_profile(raw, rules), "customer_id", "customer_key")


def translated_products(raw: RawTables) -> DataFrame:
    """The products with their English category; unknown names become Other.

    One row per product if the translation names each category once; a name that
    stands there twice repeats its products, and with them their facts.
    """
    products = keep_first(
        raw.products.select("product_id", "product_category_name"), ["product_id"]
    )
    return products.join(raw.category_translation, "product_category_name", "left").select(
        "product_id",
        F.coalesce("product_category_name_english", F.lit(UNTRANSLATED)).alias("category"),
    )


def product_price_stats(raw: RawTables, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Mean price per product over all item rows, duplicates included, in target currency."""
    return (
        raw.order_items.groupBy("product_id")
        .agg(F.sum("price").alias("total"), F.count("price").alias("n"))
        .select(
            "product_id",
            F.col("n").alias("price_count"),
            ratio(F.col("total") * F.lit(rules.currency_rate), F.col("n"))
            .cast(MONEY)
            .alias("unit_price"),
        )
    )


def product_profile(raw: RawTables, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Product dimension before its surrogate key.

    ``unit_cost`` is by the ratio of the rules, also where items carry a
    ``cost_ratio`` of their own, which sets the cost of these items only.
    """
    return (
        translated_products(raw)
        .join(product_price_stats(raw, rules), "product_id", "left")
        .select(
            "product_id",
            "category",
            F.lit(BRAND).alias("brand"),
            money(F.col("unit_price") * F.lit(rules.cost_ratio)).alias("unit_cost"),
            "unit_price",
        )
    )


def build_dim_product(raw: RawTables, rules: Rules = DEFAULT_RULES) -> DataFrame:
    return dense_keys(product_profile(raw, rules), "product_id", "product_key")


def build_dim_date(raw: RawTables) -> DataFrame:
    """One row per day that has an order."""
    day = F.col("date")
    return (
        raw.orders.select(F.to_date("order_purchase_timestamp").alias("date"))
        .where(day.isNotNull())
        .distinct()
        .select(
            date_key(day).alias("date_key"),
            "date",
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.quarter(day).alias("quarter"),
            F.date_format(day, "EEEE").alias("weekday"),
        )
    )


# -- whole star --------------------------------------------------------------


def _keyed_dimensions(raw: RawTables, rules: Rules) -> list[DataFrame]:
    return together(
        raw.orders.sparkSession,
        lambda: build_dim_customer(raw, rules),
        lambda: build_dim_product(raw, rules),
    )


def build_clean(raw: RawTables, rules: Rules = DEFAULT_RULES) -> Star:
    """Clean zone: dimensions plus the fact with natural ids."""
    dim_customer, dim_product = _keyed_dimensions(raw, rules)
    return Star(build_fact(raw, rules), dim_customer, dim_product, build_dim_date(raw))


def build_star(raw: RawTables, rules: Rules = DEFAULT_RULES) -> Star:
    """Warehouse star straight from the raw tables.

    Same rows as mapping the clean fact's keys afterwards, but the customer key
    is looked up once per order instead of once per item.
    """
    dim_customer, dim_product = _keyed_dimensions(raw, rules)
    headers = (
        order_headers(raw)
        .where(F.col("order_date").isNotNull())
        .join(dim_customer.select("customer_id", "customer_key"), "customer_id")
        .select(
            "order_id",
            date_key(F.col("order_date")).alias("order_date_key"),
            "customer_key",
            "payment_status",
            "channel",
        )
    )
    # Items go through the joins with their price; measures are added behind the last one.
    items = (
        unique_items(raw)
        .join(dim_product.select("product_id", "product_key"), "product_id")
        .join(headers, "order_id")
    )
    fact = (
        priced(items, rules)
        .where(F.col("revenue") > 0)
        .select("order_id", "order_date_key", "customer_key", "product_key", *FACT_MEASURES)
    )
    return Star(fact, dim_customer, dim_product, build_dim_date(raw))
